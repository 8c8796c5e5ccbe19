"""Exact ranks and running sums of all rows, without one task that sees all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomset.operators.rows import RESERVED
from loomset.operators.split import MAX_BUCKET_ROWS, WIDTH
from loomset.sources import stage

_BUCKET, _WIDER, _RANGE = RESERVED + "bucket", RESERVED + "wider", RESERVED + "range"


def global_ranks(
    rows: DataFrame, key: str, into: str = "rank", max_bucket_rows: int = MAX_BUCKET_ROWS
) -> DataFrame:
    """``rows`` with their place, from 0, in the order of the BINARY column ``key``.

    A histogram over the leading bytes tells how many rows come before each bucket, and
    a window ranks the rows within theirs.  Buckets that are too large for one task are
    divided by the first bytes in which their keys differ, however far behind these are,
    until they fit; only rows with one and the same key stay together, in any order.
    ``rows`` is read once for each histogram and once more: stage what is costly.
    """
    rows = rows.withColumn(_BUCKET, F.substring(key, 1, WIDTH))
    while True:
        counted = stage(
            rows.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("a"), F.max(key).alias("z"))
        )
        wide = counted.where((F.col("n") > max_bucket_rows) & (F.col("a") != F.col("z")))
        if wide.isEmpty():
            break
        # one row for each bucket of more than max_bucket_rows, so that there are few
        shorter = F.least(F.length("a"), F.length("z"))
        same = F.transform(
            F.sequence(F.lit(1), shorter), lambda i: F.substr("a", i, F.lit(1)) == F.substr("z", i, F.lit(1))
        )
        differ = F.array_position(same, False).cast("int")
        wider = F.when(differ == 0, shorter + 1).otherwise(differ) + WIDTH - 1
        rows = rows.join(F.broadcast(wide.select(_BUCKET, wider.alias(_WIDER))), _BUCKET, "left")
        longer = F.substr(key, F.lit(1), F.col(_WIDER))
        rows = rows.withColumn(_BUCKET, F.coalesce(longer, F.col(_BUCKET))).drop(_WIDER)
    # one row for each bucket
    before = F.sum("n").over(Window.orderBy(_BUCKET)) - F.col("n")
    offsets = counted.select(_BUCKET, before.alias(_WIDER))
    within = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(key))
    ranked = rows.withColumn(into, within).join(offsets, _BUCKET)
    return ranked.withColumn(into, (F.col(_WIDER) + F.col(into) - 1).cast("bigint")).drop(_BUCKET, _WIDER)


def sums_before(rows: DataFrame, order: str, value: str, into: str = "before") -> DataFrame:
    """``rows`` with the sum of ``value`` over all rows that come before in ``order``.

    Rows are dealt out by ranges of ``order`` and staged with the number of their range:
    the sums of whole ranges, one row for each, give every range its offset, and the rest
    is a running sum within the range.  ``order`` should name rows; rows that share it
    follow each other in the order of ``value``, and equal ones in any.  Only pass the
    columns that are wanted, as all are staged.
    """
    by = [F.col(order).asc_nulls_first(), F.col(value).asc_nulls_first()]
    ranged = stage(rows.repartitionByRange(*by).withColumn(_RANGE, F.spark_partition_id()))
    totals = ranged.groupBy(_RANGE).agg(F.sum(value).alias("total"))
    offset = F.sum("total").over(Window.orderBy(_RANGE)) - F.col("total")
    offsets = totals.select(F.col(_RANGE).alias(_BUCKET), offset.alias(_WIDER))
    earlier = Window.partitionBy(_RANGE).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(value).over(earlier), F.lit(0))
    # as many offsets as there are ranges
    placed = ranged.withColumn(into, local).join(F.broadcast(offsets), F.col(_RANGE) == F.col(_BUCKET))
    total = F.col(into) + F.coalesce(_WIDER, F.lit(0))
    return placed.withColumn(into, total.cast("bigint")).drop(_RANGE, _BUCKET, _WIDER)
