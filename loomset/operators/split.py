"""Reproducible train/eval split of an exact size.

Rows are ordered by a seeded hash, and the first ``ceil(val_split * n)`` of them
are held out.  No global sort is needed: a histogram over the leading bytes
finds the one bucket that the cut falls in, and only that bucket is looked at more
closely.  The result is a single cut key, so that assigning the split is a narrow
comparison that reads nothing but the row itself.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes of the key per histogram: at most 65,536 groups, whatever the data.
WIDTH = 2
# Rows that one task may sort to find the cut inside a bucket (about 100 MB).
MAX_BUCKET_ROWS = 2_000_000

SPLIT_KEY = "split_key"


class Cut(NamedTuple):
    """Rows whose key is at most ``key`` are held out."""

    key: bytes
    n_rows: int
    n_eval: int


def split_key(
    row_key: Column,
    seed: int,
    tie_break: Column | None = None,
    content: Column | None = None,
) -> Column:
    """Seeded hash of ``row_key``, which should name the row, as BINARY.

    A NULL key hashes the seed alone, which no value does.  Where ``row_key`` may
    repeat (copies of the same text, or NULL), ``tie_break`` must be a unique BIGINT;
    it decides between the copies only.  ``content`` is a second text to order
    by before that: it keeps the order of different rows with one key from depending
    on how the rows are numbered.
    """
    digest = _digest(row_key, seed)
    if content is not None:
        digest = F.concat(digest, _digest(content, seed))
    if tie_break is None:
        return digest
    return F.concat(digest, F.unhex(F.lpad(F.hex(tie_break.cast("bigint")), 16, "0")))


def _digest(value: Column, seed: int) -> Column:
    text = F.coalesce(F.concat(F.lit(":"), value.cast("string")), F.lit(""))
    return F.unhex(F.md5(F.concat(F.lit(str(seed)), text).cast("binary")))


def find_cut(
    keys: DataFrame,
    val_split: float,
    key: str = SPLIT_KEY,
    max_bucket_rows: int = MAX_BUCKET_ROWS,
) -> Cut:
    """Key of the last held-out row.

    ``keys`` is read once for the histogram and once for the bucket of the cut,
    and once more for each further ``WIDTH`` bytes while that bucket is too
    large for one task.  Even a third of all rows with one hash is only a bucket
    like any other: the bytes of the tie-break divide it further.  Where computing
    ``keys`` is costly, stage them: each read computes them again.
    """
    check_val_split(val_split)
    n_rows = n_eval = wanted = None
    prefix = b""
    while True:
        in_bucket = keys.select(key).where(F.startswith(F.col(key), F.lit(prefix)))
        bucket = F.substring(key, len(prefix) + 1, WIDTH)
        counted = in_bucket.groupBy(bucket.alias("bucket")).agg(
            F.count(F.lit(1)).alias("n")
        )
        if n_rows is None:
            # At most 65,536 counts: their total fixes how many rows to hold out.
            total = F.sum("n").over(Window.partitionBy())
            counted = counted.withColumn("total", total).withColumn(
                "wanted", F.ceil(F.lit(float(val_split)) * F.col("total")).cast("bigint")
            )
        else:
            counted = counted.withColumn("wanted", F.lit(wanted))
        hit = _first_reaching(counted, "bucket")
        if hit is None:
            raise ValueError("cannot split an empty dataset")
        if n_rows is None:
            n_rows, n_eval = hit["total"], hit["wanted"]
            wanted = n_eval
            if n_eval >= n_rows:
                raise ValueError(
                    f"val_split={val_split} of {n_rows} rows leaves no training rows"
                )
        prefix += bytes(hit["bucket"])
        wanted -= hit["reached"] - hit["n"]
        if not hit["bucket"] or hit["n"] <= max_bucket_rows:
            break
    bucket_keys = (
        keys.where(F.startswith(F.col(key), F.lit(prefix)))
        .groupBy(F.col(key).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("wanted", F.lit(wanted))
    )
    hit = _first_reaching(bucket_keys, "bucket")
    if hit["reached"] != wanted:
        raise ValueError("the split key repeats across the cut; pass a unique tie_break")
    return Cut(bytes(hit["bucket"]), n_rows, n_eval)


def _first_reaching(counted: DataFrame, order: str):
    """The first group, in order, whose running count reaches ``wanted``.

    ``counted`` holds one row per histogram bucket, or per key of one bucket, so
    the window over it is bounded by WIDTH and MAX_BUCKET_ROWS.
    """
    running = F.sum("n").over(
        Window.partitionBy().orderBy(order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    )
    return (
        counted.withColumn("reached", running)
        .where(F.col("reached") >= F.col("wanted"))
        .orderBy(order)
        .limit(1)
        .first()
    )


def assign_split(df: DataFrame, cut: Cut, key: str = SPLIT_KEY) -> DataFrame:
    """Replace the key by ``split``: ``train`` or ``eval``."""
    split = F.when(F.col(key) <= F.lit(cut.key), "eval").otherwise("train")
    return df.withColumn("split", split).drop(key)


def holdout_split(
    df: DataFrame,
    val_split: float,
    row_key: Column | str,
    seed: int = 42,
    tie_break: Column | None = None,
    max_bucket_rows: int = MAX_BUCKET_ROWS,
) -> DataFrame:
    """Add ``split``; exactly ``ceil(val_split * n)`` rows become ``eval``.

    The cut is found right away, by jobs that read only the key columns.  With
    ``val_split`` 0 every row is ``train`` and nothing is read.
    """
    check_val_split(val_split)
    if val_split == 0:
        return df.withColumn("split", F.lit("train"))
    row_key = F.col(row_key) if isinstance(row_key, str) else row_key
    if tie_break is not None:
        kind = df.select(tie_break).schema[0].dataType
        if not isinstance(kind, T.IntegralType):
            raise ValueError(f"tie_break must be a whole number, not {kind.simpleString()}")
    keyed = df.withColumn(SPLIT_KEY, split_key(row_key, seed, tie_break))
    return assign_split(keyed, find_cut(keyed, val_split, max_bucket_rows=max_bucket_rows))


def check_val_split(val_split: float) -> None:
    if not 0.0 <= val_split < 1.0:
        raise ValueError("val_split must be in [0.0, 1.0)")
