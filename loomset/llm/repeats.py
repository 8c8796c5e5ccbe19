"""Substring dedup over a compacted De Bruijn graph of word runs.

An edge of the graph is a run of ``size`` words, from the node of its first ``size`` - 1
words to that of its last; the hashes of the two nodes name it.  Only edges of more than
one document matter.

1. Each edge has a minimiser, the short run of words in it with the smallest hash.
   Equal edges have equal minimisers, and neighbouring edges mostly share one, so
   that about one short run in five words is sent to be counted.  A minimiser of a
   single document belongs to no repeated edge.  A Bloom filter of fixed size leaves
   out most edges without a repeated one; it lets all through that repeat, and
   where a very large corpus fills it, it merely spares less.
2. The edges that repeat keep their source: the smallest doc_id and a place there.
3. A node with more than one edge in, or out, is a branch.  Edges are joined to the
   branches; one that follows another in their source continues its path, unless the
   node between them is a branch.  Edges are so compacted to paths.
4. Joined back to their occurrences, the edges of one path that follow each other in a
   document are a span.  A span is removed if its words, hashed anew from the text, are
   those at its coordinates in the source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm import bitmap
from loomset.llm.words import SPACED, Words, free, map_slices, normal, row_key, schema_with, stored, texts, without
from loomset.sources import remove, shared_dir

#: Words of a minimiser.
SHORT = 5
#: Spans that are verified with one copy of their source.
SPANS_AT_ONCE = 50_000


def _minimisers(words: Words, hashes: np.ndarray, size: int):
    """Starts of all runs of ``size`` words, and the hash of each run's minimiser."""
    short = min(SHORT, size)
    at, _ = words.runs(hashes, size)
    starts, h = words.runs(hashes, short)
    dense = np.zeros(len(hashes), np.uint64)
    dense[starts] = h
    least = dense[at] if len(at) else np.zeros(0, np.uint64)
    for step in range(1, size - short + 1):
        least = np.minimum(least, dense[at + step])
    return at, least


def _ids(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _read(batch: pa.RecordBatch) -> Words:
    return Words([normal(x, SPACED) for x in texts(batch)])


def _repeated_minimisers(docs: DataFrame, size: int) -> DataFrame:
    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = _read(batch)
        at, least = _minimisers(words, words.hashes(), size)
        ids = _ids(batch, "doc_id")[words.row[at]]
        new = np.r_[True, (least[1:] != least[:-1]) | (ids[1:] != ids[:-1])][: len(at)]
        return pa.record_batch({"m": least[new].view(np.int64), "doc_id": ids[new]})

    seen = map_slices(docs, make, "m bigint, doc_id bigint").groupBy("m")
    return seen.agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).filter("a < z").select("m")


def _edges(docs: DataFrame, size: int, bits: np.ndarray) -> DataFrame:
    """Edges that may repeat: their nodes u and v, document, and spot: the row's key, and the
    place in the lower half."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = _read(batch)
        hashes = words.hashes()
        at, least = _minimisers(words, hashes, size)
        starts, h = words.runs(hashes, size - 1)
        nodes = np.zeros(len(hashes), np.uint64)
        nodes[starts] = h
        at = at[bitmap.may_hold(shared.value, least)]
        row = words.row[at]
        return pa.record_batch(
            {
                "u": nodes[at].view(np.int64),
                "v": nodes[at + 1].view(np.int64),
                "doc_id": _ids(batch, "doc_id")[row],
                "spot": (_ids(batch, "key")[row] << 32) + words.place[at],
            }
        )

    return map_slices(docs, make, "u bigint, v bigint, doc_id bigint, spot bigint")


def _key_of(spot: str) -> Column:
    return F.shiftright(spot, 32).cast("int")


def _place_of(spot: str) -> Column:
    return F.col(spot).bitwiseAND(F.lit((1 << 32) - 1)).cast("int")


def compacted(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v, source_id, source_spot) with ``path``.

    ``path`` is the spot in the source where the edge's path begins: the longest run of
    edges that follow each other there without a branch at a node between two of them.
    """
    many = F.count("*") > 1
    out = edges.groupBy("u").agg(many.alias("many")).filter("many").select(F.col("u").alias("node"))
    into = edges.groupBy("v").agg(many.alias("many")).filter("many").select(F.col("v").alias("node"))
    branches = out.union(into).distinct()
    joined = edges.join(branches, F.col("u") == F.col("node"), "left")
    # the rows of one source, each edge once
    source = Window.partitionBy("source_id", _key_of("source_spot")).orderBy("source_spot")
    follows = (F.lag("v").over(source) == F.col("u")) & (F.lag("source_spot").over(source) == F.col("source_spot") - 1)
    goes_on = F.col("node").isNull() & F.coalesce(follows, F.lit(False))
    joined = joined.withColumn("begin", F.when(~goes_on, F.col("source_spot")))
    return joined.select("u", "v", "source_id", "source_spot", F.max("begin").over(source).alias("path"))


def _row() -> Column:
    """Tells the rows of one doc_id apart by their texts."""
    return row_key().bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("key")


def repeated_spans(docs: DataFrame, size: int = 13) -> DataFrame:
    """Spans (doc_id, key, start, words, source_id, source_key, source_start) of repeated words.

    A span is a maximal run of places whose windows of ``size`` words stand one after
    the other on one path of the source, a document with a smaller doc_id; ``words``
    counts the words under all of its windows.  ``key`` tells rows of one doc_id apart.  Rows with a NULL doc_id or
    text have no spans.  The spans are stored; what led to them is deleted as soon as the
    next table stands.
    """
    if size < 3:
        raise ValueError("two nodes name the words of an edge if they share a word at least")
    base = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    keyed = base.select("doc_id", "text", _row())
    spark = docs.sparkSession
    short, firsts, ways, places_at = (shared_dir(spark) for _ in range(4))
    bits = bitmap.build(stored(_repeated_minimisers(base, size), short), "m")
    remove(spark, short)
    edges = _edges(keyed, size, bits)
    # any place of the edge in its source will do
    first = edges.groupBy("u", "v").agg(
        F.min("doc_id").alias("source_id"), F.max("doc_id").alias("last"), F.min_by("spot", "doc_id").alias("source_spot")
    )
    first = stored(first.filter("source_id < last").drop("last"), firsts)
    # an edge is one row of its path; the shuffles of the compaction are given back here
    paths = stored(compacted(first), ways)
    remove(spark, firsts)
    found = edges.join(paths.hint("shuffle_hash"), ["u", "v"]).filter("doc_id > source_id")
    found = stored(found.drop("u", "v"), places_at)
    remove(spark, ways)
    shift = F.col("spot").bitwiseAND(F.lit((1 << 32) - 1)) - F.col("source_spot").bitwiseAND(F.lit((1 << 32) - 1))
    run = ["doc_id", "key", "source_id", "path", "shift"]
    places = found.select(
        "doc_id", _key_of("spot").alias("key"), "source_id", "path", shift.cast("int").alias("shift"), _place_of("spot").alias("place")
    )
    # equal rows have the same places, and the same rank of each
    island = F.col("place") - F.dense_rank().over(Window.partitionBy(*run).orderBy("place"))
    spans = places.withColumn("island", island).groupBy(*run, "island").agg(
        F.min("place").alias("start"), (F.max("place") - F.min("place") + size).alias("words")
    )
    at = (F.col("start") - F.col("shift")).alias("source_start")
    spans = stored(spans.select("doc_id", "key", "start", "words", "source_id", _key_of("path").alias("source_key"), at))
    remove(spark, places_at)
    return spans


def _digests(text: bytes | None, spans: list[tuple[int, int]]) -> list[int]:
    """A hash of each span of words, of their bytes, by another rule than the edges'."""
    words = text.split() if text else []
    return [xxhash.xxh3_64_intdigest(b" ".join(words[a : a + n])) >> 1 for a, n in spans]


def _verified(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``spans`` with ``digest``, the hash of the words at their coordinates in the source.

    A source's text is sent once for each SPANS_AT_ONCE different spans of it.
    """
    names = ["source_id", "source_key", "source_start", "words"]
    asked = spans.select(*names).distinct()
    number = asked.groupBy("source_id", "source_key").agg(F.ceil(F.count("*") / SPANS_AT_ONCE).alias("parts"))
    part = F.pmod(F.xxhash64("source_start", "words"), F.col("parts"))
    asked = asked.join(number, ["source_id", "source_key"]).groupBy("source_id", "source_key", part.alias("part")).agg(
        F.collect_list(F.struct("source_start", "words")).alias("asked")
    )
    keyed = docs.select("doc_id", "text", _row())
    on = (F.col("doc_id") == F.col("source_id")) & (F.col("key") == F.col("source_key"))
    sources = keyed.join(asked, on).select("source_id", "source_key", "text", "asked")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, keys, told = (batch.column(c).to_pylist() for c in ("source_id", "source_key", "asked"))
        out: list[tuple] = []
        for text, i, key, asked_here in zip(texts(batch), ids, keys, told):
            pairs = [(x["source_start"], x["words"]) for x in asked_here]
            out += [(i, key, *pair, h) for pair, h in zip(pairs, _digests(text, pairs))]
        columns = list(zip(*out)) or [[]] * 5
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        return pa.record_batch([pa.array(x, t) for x, t in zip(columns, types)], [*names, "digest"])

    schema = "source_id bigint, source_key int, source_start int, words int, digest bigint"
    # a repeated row gives the same hashes again
    return spans.join(map_slices(sources, make, schema).distinct(), names)


def remove_repeats(docs: DataFrame, size: int = 13) -> DataFrame:
    """The columns of ``docs`` and n_words, n_removed and kept, the words left over.

    A word goes if a window of ``size`` words over it also starts in a document with a
    smaller doc_id.  NULL texts have no words; a text of fewer than ``size`` words and
    a row without a doc_id lose none; rows of one doc_id are not repeats of each
    other.  Windows are judged on the input.  ``kept`` joins words by one space.  A text
    is held whole, with about 60 bytes for each of its words.
    """
    spans = _verified(docs, repeated_spans(docs, size))
    cuts = spans.groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_list(F.struct("start", "words", "digest"))).alias("cuts")
    )
    base = without(docs, "n_words", "n_removed", "kept")
    names = base.columns
    row, found = free(base, "text_key"), free(base, "repeat_cuts")
    keyed = base.withColumn(row, _row())
    cuts = cuts.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("cuts").alias(found))
    on = (keyed["doc_id"] == cuts["d"]) & (keyed[row] == cuts["k"])
    joined = keyed.join(cuts, on, "left").select(*(keyed[f"`{c}`"] for c in names), cuts[found])

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, kept = [], [], []
        for text, cuts in zip(texts(batch), batch.column(found).to_pylist()):
            words = text.split() if text else []
            n_words.append(len(words))
            if cuts:
                steps = np.zeros(len(words) + 1, np.int32)
                pairs = [(c["start"], c["words"]) for c in cuts]
                own = _digests(text, pairs)
                pairs = [pair for pair, h, c in zip(pairs, own, cuts) if h == c["digest"]]
                np.add.at(steps, [a for a, _ in pairs], 1)
                np.add.at(steps, [a + n for a, n in pairs], -1)
                stay = np.flatnonzero(np.cumsum(steps)[:-1] == 0)
                words = [words[i] for i in stay.tolist()]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words))
        columns = {c: batch.column(c) for c in names}
        columns |= {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
        return pa.record_batch(columns | {"kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return map_slices(joined, make, schema_with(base, "n_words bigint, n_removed bigint, kept string"))
