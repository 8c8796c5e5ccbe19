"""Training-data preparation on Spark DataFrames."""

from loomset.functions import (
    Tokenizer,
    prepend_system_prompt,
    python_tokenizer,
    render_chatml,
    template_renderer,
)
from loomset.operators import (
    accepted,
    calibration_sample,
    cap_preference_lengths,
    corpus_text,
    dataset_ready_count,
    drop_empty_text,
    error_summary,
    fail_on_error,
    format_examples,
    holdout_split,
    length_grouped_batches,
    pack_sequences,
    packed_tokens,
    profile_keys,
    quarantined,
    read_session,
    read_sessions,
    session_slices,
    to_chat_messages,
    to_preference_examples,
    token_counts,
    truncate_to_length,
    truncated_text,
    write_sessions,
)
from loomset.plans import (
    JobError,
    PrepJob,
    PreparedData,
    ReadOptions,
    load_dpo_dataset,
    load_sft_dataset,
    load_text_corpus,
    run_prep_job,
)
from loomset.sources import SplitRoutes, discover_corpus, route_table, scan_json, scan_jsonl

__all__ = [
    "JobError",
    "PrepJob",
    "PreparedData",
    "ReadOptions",
    "SplitRoutes",
    "Tokenizer",
    "accepted",
    "calibration_sample",
    "cap_preference_lengths",
    "corpus_text",
    "dataset_ready_count",
    "discover_corpus",
    "drop_empty_text",
    "error_summary",
    "fail_on_error",
    "format_examples",
    "holdout_split",
    "length_grouped_batches",
    "load_dpo_dataset",
    "load_sft_dataset",
    "load_text_corpus",
    "pack_sequences",
    "packed_tokens",
    "prepend_system_prompt",
    "profile_keys",
    "python_tokenizer",
    "quarantined",
    "read_session",
    "read_sessions",
    "render_chatml",
    "route_table",
    "run_prep_job",
    "scan_json",
    "scan_jsonl",
    "session_slices",
    "template_renderer",
    "to_chat_messages",
    "to_preference_examples",
    "token_counts",
    "truncate_to_length",
    "truncated_text",
    "write_sessions",
]
