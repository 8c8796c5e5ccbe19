"""Operators: DataFrame to DataFrame, for use with ``df.transform(...)``."""

from loomset.operators.corpus import corpus_text
from loomset.operators.layout import (
    calibration_sample,
    cap_preference_lengths,
    length_grouped_batches,
    pack_sequences,
    packed_tokens,
    read_session,
    read_sessions,
    session_slices,
    token_counts,
    truncate_to_length,
    truncated_text,
    write_sessions,
)
from loomset.operators.messages import to_chat_messages
from loomset.operators.preference import to_preference_examples
from loomset.operators.quality import (
    accepted,
    dataset_ready_count,
    drop_empty_text,
    error_summary,
    fail_on_error,
    profile_keys,
    quarantined,
)
from loomset.operators.ranks import global_ranks, sums_before
from loomset.operators.render import format_examples
from loomset.operators.split import assign_split, find_cut, holdout_split, split_key

__all__ = [
    "accepted",
    "assign_split",
    "calibration_sample",
    "cap_preference_lengths",
    "corpus_text",
    "dataset_ready_count",
    "drop_empty_text",
    "error_summary",
    "fail_on_error",
    "find_cut",
    "format_examples",
    "global_ranks",
    "holdout_split",
    "length_grouped_batches",
    "pack_sequences",
    "packed_tokens",
    "profile_keys",
    "quarantined",
    "read_session",
    "read_sessions",
    "session_slices",
    "split_key",
    "sums_before",
    "to_chat_messages",
    "to_preference_examples",
    "token_counts",
    "truncate_to_length",
    "truncated_text",
    "write_sessions",
]
