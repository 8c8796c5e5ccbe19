"""Secrets, told from copied examples by who owns them.

Credentials are found by pattern.  Beside the kinds that always count, any long run of
key characters is a candidate.  Every candidate's value is hashed, and the corpus tells
in how many distinct repositories, and of how many distinct owners, the value stands.
What many owners hold was copied from an example; what looks like a key and belongs to
one owner is live, and becomes a span of its own even where no pattern names it.

All of it is DataFrame functions.  A pattern gives the texts of its matches, and a
split by the same pattern what lies between them: both go from left to right without
overlaps, so that the lengths of what came before are the places.  Only candidates are
kept, so that all later steps read very little.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomset.llm.words import row_key, stored

#: The kinds that always count, in order, with pattern and group.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {
    "assign": (ASSIGN, 2),
    # shorter runs than these never count; a match within a run begins where the run does
    "access": (r"AKIA[A-Z0-9]{16,}+", 0),
    "hex": (r"[0-9a-f]{24,}+", 0),
}
LEAST_ASSIGNED = 6
_MATCHES = "array<struct<kind:string, rank:int, number:int, gap:int, size:int, value:string>>"
_SPANS = "array<struct<start:int, rank:int, kind:string, end:int>>"
#: The method's own kind, and its candidates: runs of key characters.
LIVE = "live"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"
#: Distinct characters of a value that looks live, beside a digit and a letter.
LEAST_DISTINCT = 10
#: A value that more owners hold is an example.
MOST_OWNERS = 2


def _matches(text: Column, rank: int, kind: str, pattern: str, group: int) -> Column:
    """An array of (kind, rank, number, gap, size, value): matches, and what lies before each."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    # there is one gap more than matches, after the last one
    parts = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("all"), values.alias("value")), lambda x: x["all"].isNotNull())
    spans = F.transform(
        parts,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            F.lit(rank).alias("rank"),
            i.alias("number"),
            F.length(x["gap"]).alias("gap"),
            F.length(x["all"]).alias("size"),
            x["value"].alias("value"),
        ),
    )
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(F.array().cast(_MATCHES))


def _looks_live(value: Column) -> Column:
    distinct = F.size(F.array_distinct(F.filter(F.split(value, ""), lambda c: c != "")))
    return (distinct >= LEAST_DISTINCT) & F.regexp_like(value, F.lit("[0-9]")) & F.regexp_like(value, F.lit("[A-Za-z]"))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, key, repository, owner, found) for each row of ``docs``.

    ``found`` has the matches of each kind, in order, as (kind, rank, number, gap, size,
    value): gap is what lies between a match and the one before it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = [*((k, *p) for k, p in BASE.items()), (LIVE, CANDIDATE, 0)]
    found = F.concat(*(_matches(F.col("text"), i, *kind) for i, kind in enumerate(kinds)))
    rows = docs.select("doc_id", row_key().alias("key"), "repository", "owner", text.alias("text"))
    return rows.select("doc_id", "key", "repository", "owner", found.alias("found"))


def _placed(flat: DataFrame) -> DataFrame:
    """(doc_id, key, kind, start, end, hash, looks, own): base spans, and live-looking
    candidates (own) that overlap none of them; places are code points."""
    row = Window.partitionBy("doc_id", "key")
    # one exchange serves everything that follows
    rows = flat.select("doc_id", "key", "x.*").repartition("doc_id", "key").distinct()
    upto = F.sum(F.col("gap") + F.col("size")).over(row.partitionBy("doc_id", "key", "kind").orderBy("number"))
    rows = rows.withColumn("end", upto.cast("int")).withColumn("start", F.col("end") - F.col("size"))
    own = F.col("kind") == LIVE
    rows = rows.withColumn("own", own).withColumn("looks", _looks_live(F.col("value")))
    rows = rows.filter((F.col("kind") != "assign") | (F.length("value") >= LEAST_ASSIGNED)).filter(~own | F.col("looks"))
    up, down = row.orderBy("start"), row.orderBy(F.desc("start"))
    before = F.max(F.when(~own, F.col("end"))).over(up.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(~own, F.col("start"))).over(down.rangeBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("before", before).withColumn("after", after)
    clear = F.coalesce(F.expr("before <= start"), F.lit(True)) & F.coalesce(F.expr("after >= end"), F.lit(True))
    return rows.filter(~own | clear).select("doc_id", "key", "kind", "rank", "start", "end", _hash("value"), "looks", "own")


def _hash(value: str) -> Column:
    return F.xxhash64(value).alias("hash")


def ownership(mentions: DataFrame) -> DataFrame:
    """(hash, n_rows, n_repositories, n_owners) from rows (hash, repository, owner).

    Counts are taken step by step, each combined before its shuffle: a value that a
    third of all rows hold is dealt out by repository first.  A NULL repository or
    owner is one of its own.
    """
    held = mentions.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    # a repository has one owner as a rule; where it has more, it counts once for each
    owned = held.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("repositories"))
    return owned.groupBy("hash").agg(
        F.sum("n").alias("n_rows"), F.sum("repositories").alias("n_repositories"), F.count("*").alias("n_owners")
    )


def _with_counts(mentions: DataFrame, counts: DataFrame) -> DataFrame:
    """``mentions`` with the counts of their hash, whatever a hash's share of them.

    Hashes of more than a hundredth of all rows, of which there can't be more than a
    hundred, are sent to every task; the others are too rare to burden one.
    """
    total = counts.agg(F.sum("n_rows")).first()[0] or 0
    common = F.broadcast(counts.filter(F.col("n_rows") * 100 > total))
    rest = mentions.join(common.select("hash"), "hash", "left_anti")
    return mentions.join(common, "hash").unionByName(rest.join(counts, "hash"))


def scan(docs: DataFrame, most_owners: int = MOST_OWNERS) -> DataFrame:
    """(doc_id, key, base, live, n_examples, n_live) for each row of ``docs``.

    ``docs`` has doc_id, text, repository and owner; further columns are ignored.
    ``base`` are the spans of the fixed kinds and ``live`` the candidates beside them
    whose value at most ``most_owners`` owners hold, both by start and kind.  Of the base spans,
    n_examples counts those whose value more owners hold, and n_live the others that
    look live.  NULL texts are empty; equal rows have equal results, and count as often
    as they come but as one repository.  A text is held whole in one cell (2 GB).
    """
    found = stored(candidates(docs))
    flat = found.select("doc_id", "key", "repository", "owner", F.explode("found").alias("x"))
    counts = stored(ownership(flat.select(_hash("x.value"), "repository", "owner")))
    told = _with_counts(stored(_placed(flat)), counts).withColumn("example", F.col("n_owners") > most_owners)
    span = F.struct("start", "rank", "kind", "end")
    rows = told.groupBy(F.col("doc_id").alias("_d"), F.col("key").alias("_k")).agg(
        F.array_sort(F.collect_list(F.when(~F.col("own"), span))).alias("base"),
        F.array_sort(F.collect_list(F.when(F.expr("own and not example"), span))).alias("live"),
        F.count_if(F.expr("not own and example")).alias("n_examples"),
        F.count_if(F.expr("not own and not example and looks")).alias("n_live"),
    )
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k"))
    spans = [F.coalesce(c, F.array().cast(_SPANS)).alias(c) for c in ("base", "live")]
    numbers = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_examples", "n_live")]
    return found.select("doc_id", "key").join(rows, on, "left").select("doc_id", "key", *spans, *numbers)


def written(spans: str | Column) -> Column:
    """Spans as text, kind:start:end, joined by commas."""
    parts = F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def merged(base: str = "base", live: str = "live") -> Column:
    """Spans of both, by start and kind."""
    return F.array_sort(F.concat(base, live))
