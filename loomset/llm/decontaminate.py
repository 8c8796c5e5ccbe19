"""Benchmark decontamination as a prefix-filtered set join.

A window is a run of ``window`` words of a benchmark item.  Its tokens are its
shingles of three words, ordered by how often they occur in the documents.  Since a
document has to contain the whole window, the prefix that a match cannot do without
is one token: the rarest.  Documents meet windows on it; the token's place must leave
room for the window on both sides, and then the words themselves are compared.

The documents are read once.  Of each, only the stretches of words under shingles
that some item has are kept for the join, and a stretch shorter than the shortest
window is not: a Bloom filter of fixed size finds them, and the join is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm import bitmap
from loomset.llm.words import PLAIN, Words, free, map_slices, normal, row_key, stored, texts, without

#: Words of a shingle, fewer only where a whole item has fewer.
SHINGLE = 3
#: Windows are sent to every executor up to this many, and this many bytes of words.
BROADCAST_WINDOWS = 50_000
BROADCAST_BYTES = 16 << 20
#: Windows that may start in one part of a stretch.
PART = 64


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(item_id, words, n, hashes) for each window of each item.

    An item of fewer words is one window.  Items without an id or a word have none.
    """

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [normal(x, PLAIN) for x in texts(batch)]
        found = Words(rows)
        h = found.hashes()
        runs = {}
        for size in range(1, SHINGLE + 1):
            at, values = found.runs(h, size)
            runs[size] = np.zeros(len(h), np.uint64)
            runs[size][at] = values
        ids, out = batch.column("item_id").to_pylist(), ([], [], [], [])
        for i, (item, row) in enumerate(zip(ids, rows)):
            words = row.split()
            n = min(window, len(words))
            size = min(SHINGLE, n)
            for at in range(len(words) - n + 1 if n else 0):
                first = found.first[i] + at
                out[0].append(item)
                out[1].append(b" ".join(words[at : at + n]).decode())
                out[2].append(n)
                out[3].append(runs[size][first : first + n - size + 1].view(np.int64))
        types = (pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()))
        return pa.record_batch(
            [pa.array(x, t) for x, t in zip(out, types)], ["item_id", "words", "n", "hashes"]
        )

    base = items.select("item_id", "text").filter("item_id is not null")
    return map_slices(base, make, "item_id bigint, words string, n int, hashes array<bigint>")


_STRETCHES = "array<struct<start:int, size:int, own:int, words:string, hashes:array<bigint>>>"


def _stretches(docs: DataFrame, bits: np.ndarray, lengths: dict[int, tuple[int, int]]) -> DataFrame:
    """(doc_id, key, n_words, stretches) for each row; see the module's docstring.

    ``lengths`` has, for each shingle size in use, the words of the shortest and of the
    longest window.  A stretch comes in parts: ``own`` windows can start in each, and the
    words that the last of these needs are there as well, so that a row of a shingle
    carries a few words, however long the stretch is.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [normal(x, PLAIN) for x in texts(batch)]
        found = Words(rows)
        h = found.hashes()
        out: list[list[dict]] = [[] for _ in rows]
        for size, (least, most) in lengths.items():
            at, values = found.runs(h, size)
            hit = bitmap.may_hold(shared.value, values)
            at, values = at[hit], values[hit]
            # the next shingle belongs to the stretch if it starts one word on
            cut = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(found.row[at]) != 0)][: len(at)])
            for a, z in zip(cut.tolist(), np.r_[cut[1:], len(at)].tolist()):
                if z - a + size - 1 < least:
                    continue
                for b in range(a, z, PART):
                    own = min(PART, z - b)
                    to = min(z, b + own + most - size)
                    first = int(at[b])
                    words = found.data[found.start[first] : found.end[first + to - b + size - 2]].tobytes()
                    out[found.row[first]].append(
                        {
                            "start": int(found.place[first]),
                            "size": size,
                            "own": own,
                            "words": words.decode(),
                            "hashes": values[b:to].view(np.int64).tolist(),
                        }
                    )
        kind = pa.list_(
            pa.struct(
                [
                    ("start", pa.int32()), ("size", pa.int32()), ("own", pa.int32()),
                    ("words", pa.string()), ("hashes", pa.list_(pa.int64())),
                ]
            )
        )
        return pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "key": batch.column("key"),
                "n_words": pa.array(found.count),
                "stretches": pa.array(out, kind),
            }
        )

    keyed = docs.select("doc_id", "text", row_key().alias("key"))
    return map_slices(keyed, make, f"doc_id bigint, key bigint, n_words bigint, stretches {_STRETCHES}")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """(doc_id, key, n_words, n_hit, item_ids) for each row of ``docs``.

    ``docs`` needs doc_id and text, ``items`` item_id and text; other columns are
    ignored.  n_hit counts the words inside any occurrence of a window, item_ids are
    the ids (as strings, sorted) of the items with an occurring window.  A NULL or
    empty text has no words; rows with equal doc_id and text have equal results, and a
    NULL doc_id is a document like any other.  Without items nothing is hit.
    """
    wide = stored(item_windows(items, window))
    single = F.least(F.lit(SHINGLE), "n")
    sizes = wide.groupBy(single.alias("size")).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    lengths = {r["size"]: (r.least, r.most) for r in sizes.collect()}
    bits = bitmap.build(wide.select(F.explode("hashes").alias("h")), "h")
    scanned = stored(_stretches(docs, bits, lengths))
    pieces = scanned.select("doc_id", "key", F.explode("stretches").alias("s")).select("doc_id", "key", "s.*")
    # the shingles behind a part's own are those of the next one
    tokens = pieces.select("size", F.explode(F.slice("hashes", 1, F.col("own"))).alias("h"))
    counts = tokens.groupBy("size", "h").count()
    windows = wide.select("words", "n", "hashes").distinct().select(
        F.col("words").alias("window"), "n", single.alias("size"), F.posexplode("hashes").alias("off", "h")
    )
    # a window with a token that no document has can't occur
    ranked = windows.join(counts, ["size", "h"], "left")
    prefix = (
        ranked.groupBy("window", "n", "size")
        .agg(F.min(F.struct("count", "h", "off")).alias("rare"), F.count("count").alias("there"), F.count("*").alias("all"))
        .filter("there = all")
        .select("window", "n", "size", "rare.h", "rare.off")
    )
    prefix = stored(prefix)
    of_item = wide.select(F.col("words").alias("window"), "item_id").distinct()
    n, size = prefix.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window")), F.lit(0))).first()
    if n <= BROADCAST_WINDOWS and size <= BROADCAST_BYTES:
        prefix = F.broadcast(prefix)
    begin = F.col("at") - F.col("off")
    room = (begin >= 0) & (begin < F.col("own")) & (begin + F.col("n") - F.col("size") < F.col("length"))
    met = pieces.select("*", F.size("hashes").alias("length")).select(
        "doc_id", "key", "start", "size", "words", "own", "length", F.posexplode("hashes").alias("at", "h")
    )
    same = F.array_join(F.slice(F.split("words", " "), begin + 1, F.col("n")), " ") == F.col("window")
    hits = (
        met.join(prefix, ["size", "h"])
        .filter(room)
        .filter(same)
        .select("doc_id", "key", (F.col("start") + begin).alias("begin"), "n", "window")
    )
    hits = stored(hits.distinct())
    row = Window.partitionBy("doc_id", "key").orderBy("begin", "n")
    upto = F.max(F.col("begin") + F.col("n")).over(row.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("begin") + F.col("n") - F.greatest("begin", F.coalesce(upto, F.lit(0))))
    n_hit = hits.select("doc_id", "key", fresh.alias("fresh")).groupBy("doc_id", "key").agg(F.sum("fresh").alias("n_hit"))
    named = hits.select("doc_id", "key", "window").distinct().join(of_item, "window")
    ids = named.groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids")
    )
    found = n_hit.withColumnsRenamed({"doc_id": "d", "key": "k"})
    named_ids = ids.withColumnsRenamed({"doc_id": "e", "key": "l"})
    out = scanned.select("doc_id", "key", "n_words")
    out = out.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    out = out.join(named_ids, F.col("doc_id").eqNullSafe(F.col("e")) & (F.col("key") == F.col("l")), "left")
    return out.select(
        "doc_id",
        "key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` without a word of a window of ``items``, all their columns."""
    hit = contamination(docs, items, window).filter("n_hit > 0")
    hit = hit.select(F.col("doc_id").alias("d"), F.col("key").alias("k")).distinct()
    key = free(docs, "text_key")
    keyed = docs.withColumn(key, row_key())
    on = keyed["doc_id"].eqNullSafe(hit["d"]) & (keyed[key] == hit["k"])
    return without(keyed.join(hit, on, "left_anti"), key)
