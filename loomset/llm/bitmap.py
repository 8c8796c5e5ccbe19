"""A Bloom filter of fixed size over hashes, built by Spark and used in tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits (16 MB), at every size of the data.
WORDS = 1 << 21


def build(hashes: DataFrame, column: str) -> np.ndarray:
    """The filter of a BIGINT column: at most WORDS rows reach the driver."""
    rows = hashes.select(F.col(column).alias("h")).select(
        F.col("h").bitwiseAND(F.lit(WORDS - 1)).alias("slot"),
        F.expr("shiftleft(1L, cast(shiftrightunsigned(h, 58) as int))").alias("bit"),
    )
    bits = np.zeros(WORDS, np.uint64)
    for batch in rows.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow().to_batches():
        bits[batch.column("slot").to_numpy()] = batch.column("bits").to_numpy().view(np.uint64)
    return bits


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """False where a hash (uint64) is surely not in the filter."""
    slot = bits[(hashes & np.uint64(WORDS - 1)).astype(np.int64)]
    return ((slot >> (hashes >> np.uint64(58))) & np.uint64(1)).astype(bool)
