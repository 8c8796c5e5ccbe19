"""Connected components of a graph given as edges, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.words import stored


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node ``u``."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is its smallest node.

    Each round hangs the larger neighbours of a node, and then the smaller ones, on
    the smallest; only partial minima meet at a node, so that a node with very many
    edges is no burden.  Rounds go on until the edges stay the same, and each is
    written, so that the lineage does not grow.  NULL nodes have no edges.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stored(now.filter("u != v").distinct())
    size = _size(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u != v").distinct())
        small = _least(large)
        joined = large.join(small, "u")
        hung = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            joined.select("u", F.col("m").alias("v"))
        )
        after = stored(hung.filter("u != v").distinct())
        grown = _size(after)
        if grown == size:
            roots = after.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(roots.select("root", "root").distinct())
        now, size = after, grown


def _size(edges: DataFrame) -> tuple:
    """Count and order-free digest of the edges, to see whether a round changed them."""
    n, total = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return n, total
