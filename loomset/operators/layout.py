"""The layout of training input: lengths, packing, batches, sessions and samples.

Texts are never changed here.  An operator says which tokens of which row go where, as
spans of token places, and :func:`packed_tokens` or :func:`truncated_text` applies them.
Token counts are a column that is computed once (:func:`token_counts`) and read by all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomset.functions.tokens import BLANKS, Tokenizer, token_slice
from loomset.operators.ranks import global_ranks, sums_before
from loomset.operators.rows import RESERVED
from loomset.operators.split import split_key
from loomset.sources import stage

_KEY, _RANK = RESERVED + "key", RESERVED + "rank"
_GROUP, _N, _START = RESERVED + "group", RESERVED + "n", RESERVED + "start"


def _positive(**values: int) -> None:
    for name, value in values.items():
        if isinstance(value, bool) or not isinstance(value, int) or value < 1:
            raise ValueError(f"{name} has to be a positive whole number")


def _count(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast("bigint")


def token_counts(
    rows: DataFrame, tokenizer: Tokenizer = BLANKS, text: str = "text", into: str = "n_tokens"
) -> DataFrame:
    """``rows`` with the number of tokens of ``text``; NULL and empty texts have none.

    The result is lazy: stage it where more than one operator reads the counts, and with
    only the columns that these need.
    """
    return rows.withColumn(into, tokenizer.count(F.col(text)))


def truncate_to_length(rows: DataFrame, length: int, n_tokens: str = "n_tokens") -> DataFrame:
    """``rows`` with ``kept_tokens``, at most ``length``, and ``was_truncated``."""
    _positive(length=length)
    kept = F.least(_count(n_tokens), F.lit(length))
    return rows.withColumn("kept_tokens", kept).withColumn("was_truncated", _count(n_tokens) > length)


def truncated_text(text: Column, kept: Column | int) -> Column:
    """The first ``kept`` tokens of a text, by the default tokenizer."""
    return token_slice(text, 0, kept)


def cap_preference_lengths(
    rows: DataFrame,
    max_length: int = 2048,
    max_prompt_length: int = 1024,
    n_prompt: str = "n_prompt",
    n_chosen: str = "n_chosen",
    n_rejected: str = "n_rejected",
) -> DataFrame:
    """``rows`` with the spans of tokens that fit: the end of the prompt, the start of the
    answers.

    The prompt keeps its last ``max_prompt_length`` tokens, ``prompt_from`` to
    ``prompt_to``, and each answer, up to ``chosen_to`` and ``rejected_to``, what the kept
    prompt leaves of ``max_length``.  ``was_capped`` says whether a token is left out.
    """
    _positive(max_length=max_length, max_prompt_length=max_prompt_length)
    if max_prompt_length >= max_length:
        raise ValueError("max_prompt_length has to be below max_length, or no answer fits")
    prompt, chosen, rejected = _count(n_prompt), _count(n_chosen), _count(n_rejected)
    kept = F.least(prompt, F.lit(max_prompt_length))
    spans = {
        "prompt_from": prompt - kept,
        "prompt_to": prompt,
        "chosen_to": F.least(chosen, max_length - kept),
        "rejected_to": F.least(rejected, max_length - kept),
    }
    capped = (prompt > kept) | (chosen > max_length - kept) | (rejected > max_length - kept)
    return rows.withColumns(spans).withColumn("was_capped", capped)


def pack_sequences(
    rows: DataFrame,
    length: int,
    row_id: str = "row_id",
    n_tokens: str = "n_tokens",
    separators: int = 1,
    keep_last: bool = True,
) -> DataFrame:
    """Pack rows, in the order of ``row_id``, into sequences of ``length`` tokens.

    All tokens form one stream, with ``separators`` tokens after each row, that is cut
    every ``length`` tokens.  The result has one row for each piece: ``seq_id``,
    ``row_id``, the span ``tok_from`` to ``tok_to`` of the row's tokens, separators
    included, and ``seq_from``, where it begins in the sequence.  Rows with neither
    tokens nor separators have no piece.  The last sequence may be short;
    ``keep_last=False`` leaves it out then.
    """
    _positive(length=length)
    if separators < 0:
        raise ValueError("separators can't be negative")
    counted = rows.select(row_id, (_count(n_tokens) + separators).alias(_N))
    placed = sums_before(counted, row_id, _N, _START).where(F.col(_N) > 0)
    start, end = F.col(_START), F.col(_START) + F.col(_N)
    last = F.floor((end - 1) / length)
    first = F.floor(start / length)
    pieces = placed.withColumn("seq_id", F.explode(F.sequence(first, last)))
    low = F.greatest(start, F.col("seq_id") * length)
    high = F.least(end, (F.col("seq_id") + 1) * length)
    spans = pieces.select(
        "seq_id",
        row_id,
        (low - start).alias("tok_from"),
        (high - start).alias("tok_to"),
        (low - F.col("seq_id") * length).alias("seq_from"),
    )
    if keep_last:
        return spans
    # one number: the tokens of everything, of which whole sequences stay
    whole = counted.agg(F.floor(F.coalesce(F.sum(_N), F.lit(0)) / length).alias(_RANK))
    return spans.join(F.broadcast(whole), F.col("seq_id") < F.col(_RANK)).drop(_RANK)


def packed_tokens(
    spans: DataFrame, rows: DataFrame, separator: Column, row_id: str = "row_id", tokens: str = "tokens"
) -> DataFrame:
    """``seq_id`` and ``tokens``: the sequences that :func:`pack_sequences` describes.

    ``rows`` has ``row_id``, which is unique and not NULL, and the array of its tokens;
    ``separator`` is the one token behind each row.  A sequence is put together in one task, and holds no more than its
    length; a long row is sent once, and cut where it is read.
    """
    held = rows.select(F.col(row_id).alias(_KEY), F.concat(tokens, F.array(separator)).alias(tokens))
    asked = spans.groupBy(F.col(row_id).alias(_KEY)).agg(F.collect_list(F.struct("seq_id", "seq_from", "tok_from", "tok_to")).alias(_N))

    def piece(x: Column) -> Column:
        part = F.slice(tokens, (x["tok_from"] + 1).cast("int"), (x["tok_to"] - x["tok_from"]).cast("int"))
        return F.struct(x["seq_id"].alias("seq_id"), F.struct(x["seq_from"].alias("seq_from"), part.alias(tokens)).alias(_N))

    cut = held.join(asked, _KEY).select(F.inline(F.transform(_N, piece)))
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(_N)), lambda x: x[tokens]))
    return cut.groupBy("seq_id").agg(whole.alias(tokens))


def length_grouped_batches(
    rows: DataFrame,
    batch_size: int,
    row_id: str = "row_id",
    n_tokens: str = "n_tokens",
    seed: int = 42,
    batches_per_group: int = 50,
) -> DataFrame:
    """``row_id`` and ``batch_id``: batches of rows of similar length, in seeded order.

    Rows are shuffled by a seeded hash of ``row_id`` and taken in groups of
    ``batches_per_group`` batches; within a group the longest come first.  Batches differ
    from run to run only with ``seed``, whatever the files; rows that share their id
    and length are interchangeable.
    """
    _positive(batch_size=batch_size, batches_per_group=batches_per_group)
    key = split_key(F.col(row_id), seed, tie_break=_count(n_tokens))
    narrow = stage(rows.select(row_id, _count(n_tokens).alias(_N), key.alias(_KEY)))
    ranked = global_ranks(narrow, _KEY, _RANK)
    ranked = ranked.withColumn(_GROUP, F.floor(F.col(_RANK) / (batch_size * batches_per_group)))
    # a group is of a fixed size
    order = Window.partitionBy(_GROUP).orderBy(F.desc(_N), F.col(row_id).asc_nulls_first(), _RANK)
    place = F.floor((F.row_number().over(order) - 1) / batch_size)
    return ranked.select(row_id, (F.col(_GROUP) * batches_per_group + place).alias("batch_id"))


def session_slices(units: DataFrame, effective_batch: int, max_steps: int, unit: str = "seq_id") -> DataFrame:
    """``units`` with ``step`` and ``session_id``: sessions of ``max_steps`` training steps.

    ``unit`` numbers sequences or batches from 0; a step takes ``effective_batch`` of
    them, and a session is a contiguous range of steps.
    """
    _positive(effective_batch=effective_batch, max_steps=max_steps)
    step = F.floor(F.col(unit) / effective_batch)
    return units.withColumn("step", step).withColumn("session_id", F.floor(F.col("step") / max_steps))


def write_sessions(sessions: DataFrame, path: str) -> None:
    """Write ``sessions`` with one directory each.

    Rows are not shuffled: packed pieces already lie in the order of their sequences, so
    that a task writes to few directories.
    """
    sessions.write.partitionBy("session_id").parquet(path)


def read_session(spark: SparkSession, path: str, session_id: int) -> DataFrame:
    """The rows of one session; the directories of others are not read.

    Each call lists all directories: take :func:`read_sessions` for more than a few.
    """
    return spark.read.parquet(path).where(F.col("session_id") == session_id)


def read_sessions(spark: SparkSession, path: str, first: int = 0, last: int | None = None) -> DataFrame:
    """The rows of sessions ``first`` to ``last``, that included, or of all from ``first`` on.

    The directories are listed once and read in one scan, however many sessions there
    are; those of other sessions are not read.
    """
    rows = spark.read.parquet(path).where(F.col("session_id") >= first)
    return rows if last is None else rows.where(F.col("session_id") <= last)


def calibration_sample(
    rows: DataFrame,
    n: int,
    row_key: str = "row_id",
    content: str | None = "text",
    seed: int = 42,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash, of each group of ``by`` if given.

    A task keeps its ``n`` best and passes only these on, for each group; nothing is
    sorted as a whole.  The hash is that of ``row_key`` and then of ``content``, so that
    the same rows are chosen whatever the files; equal rows are interchangeable.
    """
    _positive(n=n)
    key = split_key(F.col(row_key), seed, content=F.col(content) if content else None)
    keyed = rows.withColumn(_KEY, key)
    if not by:
        return keyed.orderBy(_KEY).limit(n).drop(_KEY)
    order = Window.partitionBy(*by).orderBy(_KEY)
    return keyed.withColumn(_RANK, F.row_number().over(order)).where(F.col(_RANK) <= n).drop(_KEY, _RANK)
