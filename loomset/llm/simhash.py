"""SimHash near-duplicates by a generalised pigeonhole search.

Fingerprints whose Hamming distance is at most ``max_bits`` are linked.  The 64 bits
are dealt into partitions, bits that rise and fall together into the same one, and
each partition gets a threshold of its own.  If the thresholds plus one add up to
``max_bits`` + 1, every pair within the distance agrees, up to the threshold, in one
partition at least; a threshold of -1 leaves a partition out.  Dynamic programming
chooses the thresholds from candidate counts that are estimated on all fingerprints.

Groups of copies do not make pairs: equal fingerprints are one node, and the nodes of
a crowded bucket are linked through the values next to them instead (two values are
at most two bits apart if, and only if, they share a value one bit from both or are
one bit apart), which takes one row for each bit that varies in the bucket, 65 at
most for each node, however large the bucket is.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomset.llm.components import components
from loomset.llm.words import SPACED_LOWER, free, map_slices, normal, row_key, stored, texts, without

SEED = 42
#: More nodes than this in one bucket are linked through neighbouring values.
CROWD = 32


def fingerprint(words: bytes, size: int = 3) -> int:
    """Majority bits of the XXH64 of all shingles of words joined by one space."""
    if not words:
        return 0
    gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 32).tolist()
    starts, ends = [0, *(g + 1 for g in gaps)], [*gaps, len(words)]
    digest = xxhash.xxh64_intdigest
    ends = ends[size - 1 :] or [len(words)]
    h = np.array([digest(words[a:b], SEED) for a, b in zip(starts, ends)], "<u8")
    total = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8), bitorder="little")
        total += bits.reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return sum(1 << int(b) for b in np.flatnonzero(2 * total > len(h)))


def fingerprints(docs: DataFrame, size: int = 3, more: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp long) for each row of ``docs``; fp is 0 for texts without a word.

    ``more`` names further BIGINT columns to keep.
    """
    names = ("doc_id", *more)

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(normal(x, SPACED_LOWER), size) for x in texts(batch)]
        fp = np.array(found, np.uint64).view(np.int64)
        return pa.record_batch({c: batch.column(c) for c in names} | {"fp": pa.array(fp)})

    schema = ", ".join(f"{c} bigint" for c in (*names, "fp"))
    return map_slices(docs.select(*names, "text"), make, schema)


def bit_sums(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and in how many each pair of bits is set."""

    def make(batches):
        n, both = 0, np.zeros((64, 64), np.int64)
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view("<u8")
            n += len(fp)
            for at in range(0, len(fp), 1 << 14):
                part = np.ascontiguousarray(fp[at : at + (1 << 14)])
                bits = np.unpackbits(part.view(np.uint8), bitorder="little")
                x = bits.reshape(-1, 64).astype(np.float32)
                both += (x.T @ x).astype(np.int64)
        at = np.append(np.arange(64 * 64), -1)
        yield pa.record_batch({"at": at, "n": np.append(both.ravel(), n)})

    sums = nodes.select("fp").mapInArrow(make, "at bigint, n bigint")
    rows = dict(sums.groupBy("at").agg(F.sum("n").alias("n")).collect())
    both = np.array([rows.get(i, 0) for i in range(64 * 64)], np.int64).reshape(64, 64)
    return rows.get(-1, 0), both


def grouped_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the 64 bits into ``parts`` of about equal size, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    link = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    left, groups = list(range(64)), []
    for k in range(parts, 0, -1):
        room = len(left) // k
        group = [max(left, key=lambda b: (link[b][left].sum(), -b))]
        left.remove(group[0])
        while len(group) < room:
            group.append(max(left, key=lambda b: (link[b][group].sum(), -b)))
            left.remove(group[-1])
        groups.append(sorted(group))
    return groups


def _part(bits: list[int]):
    """The bits of one partition of ``fp``, as a number."""
    mask = sum(1 << b for b in bits)
    return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint"))


def _probes(bits: list[int], threshold: int) -> list[int]:
    """What to flip to reach every value within ``threshold`` bits of a partition."""
    flips = [0]
    last = {0: -1}
    for _ in range(max(threshold, 0)):
        more = []
        for f, at in last.items():
            more += [(f | 1 << bits[i], i) for i in range(at + 1, len(bits))]
        flips += [f for f, _ in more]
        last = dict(more)
    return flips


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up, one for each partition, whose sum plus one each is
    ``total``, at the least sum of ``costs[partition][threshold + 1]``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        reached: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for step, more in enumerate(row):
                if used + step <= total:
                    new = (cost + more, [*chosen, step - 1])
                    if used + step not in reached or new < reached[used + step]:
                        reached[used + step] = new
        best = reached
    return best[total]


def plan(nodes: DataFrame, max_bits: int) -> list[tuple[list[int], int]]:
    """Partitions and their thresholds, for the fewest estimated rows.

    How often two fingerprints agree in a whole partition is counted for every
    partition that is considered; the share that differs in one bit more follows
    from how evenly each bit is set.
    """
    n, both = bit_sums(nodes)
    p = np.diag(both) / max(n, 1)
    same = np.clip(p * p + (1 - p) * (1 - p), 0.5, 1 - 1e-9)
    layouts = [grouped_bits(n, both, k) for k in range(2, max_bits + 3)]
    groups = [bits for layout in layouts for bits in layout]
    counted = nodes.select(
        F.explode(F.array(*(F.struct(F.lit(i).alias("i"), _part(b).alias("v")) for i, b in enumerate(groups)))).alias("x")
    ).select("x.*")
    sizes = counted.groupBy("i", "v").count()
    agree = dict(
        sizes.groupBy("i").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1)).alias("x")).collect()
    )
    best = None
    at = 0
    for layout in layouts:
        costs = []
        for bits in layout:
            row, pairs, odds = [0.0], agree.get(at, 0.0) / 2, (1 - same[bits]) / same[bits]
            ways = np.zeros(max_bits + 2)
            ways[0] = 1
            for o in odds:
                ways[1:] += ways[:-1] * o
            for t in range(max_bits + 1):
                row.append(len(_probes(bits, t)) * n + pairs * ways[: t + 1].sum())
            costs.append(row)
            at += 1
        cost, thresholds = allocate(costs, max_bits + 1)
        if best is None or cost < best[0]:
            best = (cost, list(zip(layout, thresholds)))
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _flipped(name: str, flips: list[int]):
    values = F.array(*(F.lit(_signed(f)).cast("bigint") for f in flips))
    return F.transform(values, lambda f: F.col(name).bitwiseXOR(f))


def links(nodes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Edges (a, b) between fingerprints that connect all within ``max_bits`` bits."""
    if max_bits != 2:
        raise ValueError("crowded buckets are linked through values one bit away: two bits")
    chosen = [(i, bits, t) for i, (bits, t) in enumerate(plan(nodes, max_bits)) if t >= 0]
    buckets = [
        nodes.select("fp", F.lit(i).alias("i"), _part(bits).alias("v")) for i, bits, _ in chosen
    ]
    probes = [
        nodes.select("fp", F.lit(i).alias("i"), _part(bits).alias("w")).select(
            "fp", "i", F.explode(_flipped("w", _probes(bits, t))).alias("v")
        )
        for i, bits, t in chosen
    ]
    held = stored(reduce(DataFrame.union, buckets))
    asked = reduce(DataFrame.union, probes)
    crowd = held.groupBy("i", "v").count().filter(F.col("count") > CROWD).select("i", "v")
    crowd = stored(crowd)
    quiet = held.join(crowd, ["i", "v"], "left_anti").select("i", "v", F.col("fp").alias("b"))
    pairs = asked.withColumnRenamed("fp", "a").join(quiet, ["i", "v"])
    near = pairs.filter(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    ).select("a", "b")
    # those that ask a crowded bucket and those in it, each once; two of them can only
    # differ in bits that vary in their bucket
    crowded = asked.join(crowd, ["i", "v"], "left_semi")
    vary = crowded.groupBy("i", "v").agg(F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("bits"))
    busy = crowded.join(stored(vary), ["i", "v"]).groupBy("fp").agg(F.bit_or("bits").alias("bits"))
    flips = F.filter(
        F.array(*(F.lit(_signed(1 << b)).cast("bigint") for b in range(64))),
        lambda f: f.bitwiseAND(F.col("bits")) != 0,
    )
    values = F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))
    around = busy.select("fp", F.explode(F.concat(F.array("fp"), values)).alias("near"))
    heads = around.groupBy("near").agg(F.min("fp").alias("a"), F.max("fp").alias("z"))
    heads = heads.filter(F.col("a") < F.col("z")).select("near", "a")
    star = around.join(heads, "near").filter(F.col("fp") != F.col("a"))
    return near.union(star.select("a", F.col("fp").alias("b"))).distinct()


def near_duplicates(docs: DataFrame, max_bits: int = 2, size: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    Needs columns ``doc_id`` and ``text``; others are ignored.  component_id is the
    smallest doc_id that links lead to.  Texts that are NULL, empty or without words
    have the fingerprint zero and are linked like any other.  Repeated rows stay, each
    with the same result; a NULL doc_id never becomes a component_id unless the whole
    component has no other.  No rows give no rows.
    """
    return _grouped(stored(fingerprints(docs, size)), max_bits).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def _grouped(prints: DataFrame, max_bits: int) -> DataFrame:
    """``prints`` (doc_id, fp, ...) with component_id."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    edges = stored(links(nodes.select("fp"), max_bits))
    joined = components(edges)
    of = nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    result = of.select("fp", "root").join(least, "root").select("fp", "root", "component_id")
    return prints.join(result, "fp")


def deduplicate(docs: DataFrame, max_bits: int = 2, size: int = 3) -> DataFrame:
    """One row of ``docs`` for each component, all its columns.

    It is a row with the smallest doc_id of the component; where several have it (or
    none has one), that whose text has the smallest hash, and of equal rows any one.
    Only ids, hashes and fingerprints are shuffled to choose it; texts are read once
    more, and joined to what was chosen.
    """
    keyed = docs.select("doc_id", "text", row_key().alias("key"))
    prints = stored(fingerprints(keyed, size, ("key",)))
    chosen = _grouped(prints, max_bits).filter("doc_id <=> component_id")
    equal = chosen.groupBy("root", "doc_id", "key").agg(F.count("*").alias("n"))
    least = equal.groupBy("root").agg(F.min(F.struct("key", "n", "doc_id")).alias("x"))
    least = stored(least.select(F.col("x.doc_id").alias("d"), F.col("x.key").alias("k"), F.col("x.n").alias("n")))
    row = free(docs, "text_key")
    keyed = docs.withColumn(row, row_key())

    def rows_of(some: DataFrame) -> DataFrame:
        same = keyed["doc_id"].eqNullSafe(some["d"]) & (keyed[row] == some["k"])
        return keyed.join(some, same, "left_semi")

    once, often = rows_of(least.filter("n = 1")), rows_of(least.filter("n > 1"))
    return without(once.union(often.dropDuplicates(["doc_id", row])), row)
