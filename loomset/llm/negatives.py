"""Hard negatives by coordinate pruning in length buckets.

Vectors are quantised to whole numbers, and a score is their inner product, so that
every result is exact.  Rows lie in buckets of similar length, and a bucket in blocks of
bounded size.  Anchors meet all rows, a block of them against a block of rows, unless the
longest vectors of both stay below all thresholds.  Within a block of rows, each
coordinate of the directions (vectors of length one) has a sorted list.  To find the rows
that score at least t with an anchor,

1. the block is passed over if its longest vector, in the anchor's direction, stays below t;
2. else each of the anchor's FOCUS largest coordinates gives the range of values that a
   row of the wanted angle can have there, which is looked up in the sorted list;
3. the rows that lie in all of these ranges are verified by their exact scores.

Thresholds start from a seed of bounded size: the k-th best score in any set of rows is a
lower bound of the k-th best of all, so that the seed decides how much is pruned and
never what is found.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.words import stored

#: Each component is multiplied by this and rounded down.
SCALE = 256
#: Lengths in a bucket differ by less than this factor.
RATIO = 1.1
#: Rows, and anchors, of a block; a task holds one block of each.
BLOCK = 8192
#: Rows that the first thresholds come from.
SEED_ROWS = 2048
#: Coordinates whose ranges are intersected.
FOCUS = 4
#: Ranges are wider by this, which is more than rounding takes from a cosine.
SLACK = 1e-6

_LEAST, _MOST = -(2**63), 2**63 - 1
_BAND = "array<struct<id:bigint, row:bigint, score:bigint, low:bigint, high:bigint>>"
_FOUND = ("vec_id", "row", "band_id", "band_row", "band_score", "met_id", "met_row", "score")


def quantised(rows: DataFrame, label: Column, anchor: Column, vector: str = "embedding") -> DataFrame:
    """(vec_id, row, label, anchor, v, square, dim) of the rows that take part, each once.

    Those without an id, a label or a vector, and with a component that is NULL or no
    finite number, take no part, nor do vectors of 2**31 or longer, whose scores might not
    fit 64 bits.  ``row`` tells different rows of one id apart, and decides their ties.
    """
    wide = F.transform(vector, lambda x: x.cast("double"))
    kept = rows.select("vec_id", label.cast("bigint").alias("label"), anchor.alias("anchor"), wide.alias("w"))
    finite = F.forall("w", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = kept.filter("vec_id is not null and label is not null and w is not null").filter(finite)
    square = F.aggregate("w", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x * SCALE).cast("double"), 2.0))
    kept = kept.withColumn("square", square).filter(F.col("square") < 2.0**62)
    scaled = F.transform("w", lambda x: F.floor(x * SCALE))
    kept = kept.select("vec_id", "label", "anchor", scaled.alias("v"), "square", F.size("w").alias("dim"))
    return kept.withColumn("row", F.xxhash64("label", "v")).distinct()


def _in_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` with ``bucket``, by length, and ``block``, its part of the bucket."""
    step = 2 * float(np.log(RATIO))
    bucket = F.when(F.col("square") > 0, F.floor(F.log("square") / step)).otherwise(-1).cast("int")
    rows = rows.withColumn("bucket", bucket)
    sizes = rows.groupBy(F.col("dim").alias("_dim"), F.col("bucket").alias("_bucket")).agg(
        F.ceil(F.count("*") / BLOCK).alias("blocks")
    )
    same = (F.col("dim") == F.col("_dim")) & (F.col("bucket") == F.col("_bucket"))
    block = F.pmod(F.xxhash64("vec_id", "row"), F.col("blocks")).cast("int").alias("block")
    # a length below 2**31 makes at most 226 buckets for each dimension
    return rows.join(sizes, same).select(*rows.columns, block)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _vectors(table: pa.Table, dim: int) -> np.ndarray:
    parts = table.column("v").combine_chunks()
    return parts.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(parts), dim)


class Block:
    """Rows by vec_id, and the sorted lists of their directions' coordinates."""

    def __init__(self, table: pa.Table, dim: int):
        table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        self.ids, self.rows, self.labels = (_numbers(table, c) for c in ("vec_id", "row", "label"))
        self.v = _vectors(table, dim)
        lengths = np.sqrt(table.column("square").to_numpy())
        self.longest = lengths.max(initial=0.0)
        self.unit = self.v / np.maximum(lengths, 1.0)[:, None]
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self._lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self._lists[f] = order, self.unit[order, f]
        return self._lists[f]

    def reaching(self, anchor: np.ndarray, length: float, least: int) -> np.ndarray:
        """The rows that may score ``least`` or more with an anchor: none of those is missing."""
        n = len(self.ids)
        if least <= 0:
            return np.arange(n)
        cosine = least / max(length * self.longest, 1e-300)
        if cosine > 1 + SLACK:
            return np.zeros(0, np.int64)
        widest = np.arccos(min(1.0, cosine - SLACK))
        focus = np.argsort(-np.abs(anchor), kind="stable")[:FOCUS]
        met = np.zeros(n, np.int8)
        for f in focus.tolist():
            angle = np.arccos(np.clip(anchor[f] / length, -1.0, 1.0))
            order, values = self._list(f)
            low = np.searchsorted(values, np.cos(min(np.pi, angle + widest)) - SLACK)
            high = np.searchsorted(values, np.cos(max(0.0, angle - widest)) + SLACK, "right")
            met[order[low:high]] += 1
        return np.flatnonzero(met == len(focus))


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, in that order; of equals the first ones."""
    kept = np.arange(len(scores))
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        ties = np.flatnonzero(scores == least)[: k - len(above)]
        kept = np.sort(np.concatenate([above, ties]))
    return kept[np.argsort(-scores[kept], kind="stable")]


class Search(NamedTuple):
    """What is looked for: the best ``k`` rows, of the anchor's label or of others."""

    k: int
    same_label: bool

    def run(self, anchors: DataFrame, blocks: DataFrame) -> DataFrame:
        """The best ``k`` of each anchor and band (_FOUND, rank from 1)."""
        # a block of rows and one of anchors meet if their longest vectors reach a threshold
        longest = F.sqrt(F.max("square"))
        there = blocks.groupBy("dim", "bucket", "block").agg(longest.alias("longest"))
        least = F.array_min(F.transform("bands", lambda x: x["low"]))
        parts = anchors.groupBy(F.col("dim").alias("_dim"), "part").agg(longest.alias("reach"), F.min(least).alias("least"))
        may = F.col("longest") * F.col("reach") * (1 + SLACK) >= F.col("least")
        pairs = stored(there.join(parts, (F.col("dim") == F.col("_dim")) & may).select("dim", "bucket", "block", "part"))
        on = ["dim", "bucket", "block", "part"]
        left = anchors.join(pairs, ["dim", "part"])
        # new columns, since rows and anchors come from one table
        left = left.toDF(*left.columns).groupBy(*on)
        right = blocks.drop("anchor").join(pairs, ["dim", "bucket", "block"]).groupBy(*on)
        schema = ", ".join(f"{c} bigint" for c in _FOUND)
        found = left.cogroup(right).applyInArrow(lambda a, b: self._match(a, b), schema)
        order = Window.partitionBy(*_FOUND[:5]).orderBy(F.desc("score"), "met_id", "met_row")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= self.k)

    def _match(self, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if anchors.num_rows and rows.num_rows:
            dim = anchors.column("dim")[0].as_py()
            block, vectors = Block(rows, dim), _vectors(anchors, dim)
            columns = (anchors.column(c).to_pylist() for c in ("vec_id", "row", "label", "square", "bands"))
            for v, *anchor in zip(vectors, *columns):
                self._one(found, block, v, *anchor)
        parts = list(zip(*found)) or [[]] * len(_FOUND)
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(_FOUND, parts)})

    def _one(self, found, block: Block, v: np.ndarray, vec_id: int, row: int, label: int, square: float, bands) -> None:
        may = block.reaching(v, square**0.5, min(b["low"] for b in bands))
        if self.same_label:
            may = may[(block.labels[may] == label) & ((block.ids[may] != vec_id) | (block.rows[may] != row))]
        else:
            may = may[block.labels[may] != label]
        # partial sums may wrap around, but the whole one fits 64 bits
        scores = block.v[may] @ v
        for b in bands:
            inside = np.flatnonzero((scores >= b["low"]) & (scores <= b["high"]))
            for i in inside[best(scores[inside], self.k)].tolist():
                at = may[i]
                found.append((vec_id, row, b["id"], b["row"], b["score"], block.ids[at], block.rows[at], scores[i]))

    def raised(self, anchors: DataFrame, seed: DataFrame) -> DataFrame:
        """``anchors`` with ``low`` of each band raised to the k-th best score in ``seed``."""
        kth = self.run(anchors, seed).filter(F.col("rank") == self.k)
        entry = F.struct(F.struct("band_id", "band_row"), "score")
        kth = kth.groupBy(F.col("vec_id").alias("_id"), F.col("row").alias("_row")).agg(
            F.map_from_entries(F.collect_list(entry)).alias("kth")
        )
        on = (F.col("vec_id") == F.col("_id")) & (F.col("row") == F.col("_row"))
        def band(x: Column) -> Column:
            low = F.greatest(x["low"], F.col("kth")[F.struct(x["id"].alias("band_id"), x["row"].alias("band_row"))])
            return x.withField("low", low)

        joined = anchors.join(kth, on, "left")
        return joined.withColumn("bands", F.transform("bands", band)).drop("_id", "_row", "kth")


def _percent(score: Column, percent: int) -> Column:
    return score.cast("decimal(20,0)") * F.lit(percent).cast("decimal(5,0)") / F.lit(100).cast("decimal(3,0)")


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
    vector: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has vec_id and ``vector``; ``anchor`` says which of them are anchors, and
    ``label`` gives the class.  The positives of an anchor are its best other rows of
    the same label, and its hard negatives for a positive the best rows of other labels
    whose score lies between ``least_percent`` and ``most_percent`` of the positive's,
    ends included.  Higher scores come first, then smaller ids.

    Which rows take no part is said at ``quantised``.  Equal rows count once; rows of
    one id with different labels or vectors are different rows.  Vectors of another
    dimension than the anchor's are not compared with it.  A vector of zeros scores 0.
    An anchor without a positive, and a positive with an empty band, give no rows.
    """
    base = stored(_in_blocks(quantised(rows, label, anchor, vector)))
    part = F.pmod(F.xxhash64("vec_id", "row"), F.ceil(F.col("n") / BLOCK)).cast("int")
    chosen = base.filter("anchor").drop("bucket", "block", "anchor")
    counts = chosen.groupBy(F.col("dim").alias("_dim")).agg(F.count("*").alias("n"))
    chosen = chosen.join(counts, F.col("dim") == F.col("_dim")).withColumn("part", part).drop("_dim", "n")
    seed = base.orderBy(F.xxhash64("row", "vec_id"), "vec_id").limit(SEED_ROWS)
    seed = stored(seed.withColumn("bucket", F.lit(0)).withColumn("block", F.lit(0)))

    like = Search(positives, same_label=True)
    zero, least, most = (F.lit(x).cast("bigint") for x in (0, _LEAST, _MOST))
    whole = F.struct(zero.alias("id"), zero.alias("row"), zero.alias("score"), least.alias("low"), most.alias("high"))
    near = stored(like.run(like.raised(chosen.withColumn("bands", F.array(whole)), seed), base))

    band = F.struct(
        F.col("met_id").alias("id"),
        F.col("met_row").alias("row"),
        "score",
        F.ceil(_percent(F.col("score"), least_percent)).cast("bigint").alias("low"),
        F.floor(_percent(F.col("score"), most_percent)).cast("bigint").alias("high"),
    )
    bands = near.groupBy(F.col("vec_id").alias("_id"), F.col("row").alias("_row")).agg(
        F.collect_list(band).cast(_BAND).alias("bands")
    )
    on = (F.col("vec_id") == F.col("_id")) & (F.col("row") == F.col("_row"))
    asked = chosen.join(bands.withColumn("bands", F.filter("bands", lambda x: x["low"] <= x["high"])), on).drop("_id", "_row")
    unlike = Search(negatives, same_label=False)
    asked = stored(unlike.raised(asked.filter("size(bands) > 0"), seed))
    return unlike.run(asked, base).select(
        F.col("vec_id").alias("anchor_id"),
        F.col("band_id").alias("positive_id"),
        "rank",
        F.col("met_id").alias("negative_id"),
        F.col("band_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
