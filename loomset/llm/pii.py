"""Personal data, and the words that give it away.

Mail addresses, IP addresses, card and telephone numbers are found by pattern.  Each
value is a protected entity.  A term near it (the words around it, in the rows that
hold it) discloses it as far as

    PMI(entity, term) / IC(entity) = ln(N * n_et / (n_e * n_t)) / ln(N / n_e)

comes close to 1, where N counts rows, n_e and n_t those with the entity or the term, and
n_et those with the term near the entity.  At 1 the term occurs nowhere else.  Since
every rare word would pass by chance, a term also needs to stand near the entity in
several documents, and in several different contexts; copies of a passage are one
context.

The texts are then read a second time: in every document that holds an entity, all places
of the terms that disclose it are found, near the entity or far from it.  They are
generalised, or removed where they reach a second threshold, if one is set.  A document without the entity keeps
the term: where the two stood together one of them is left no more, so that nothing leads
from the term to the entity.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomset.llm import bitmap
from loomset.llm.words import PLAIN, Words, free, map_slices, normal, row_key, slices, stored, texts

KINDS = ("email", "ip", "card", "phone")
#: The method's own kind.
TERM = "term"
#: Words on each side of an entity that are its context.
CONTEXT = 8
#: At this share of the entity's information a term is generalised.
GENERALISE = 0.9
#: A task passes its counts on when it holds this many terms.
HELD_TERMS = 100_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){12,}+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _byte(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def _luhn(digits: list[int]) -> bool:
    doubled = (2 * d - 9 * (d > 4) for d in digits[-2::-2])
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as in KINDS, then start."""
    found = [("email", a, z) for a, z in _emails(text)] if "@" in text else []
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m.groups()))]
    for m in _CARD.finditer(text):
        digits = [int(c) for c in m[0] if c.isdigit()] if m.end() - m.start() <= 37 else []
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return found


def _free_words(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Places of the words that overlap no entity."""
    words = [m.span() for m in _WORD.finditer(text)]
    starts = [a for a, _ in words]
    inside = np.zeros(len(words) + 1, bool)
    for _, a, z in spans:
        low = max(bisect_left(starts, a) - 1, 0)
        for i in range(low, bisect_left(starts, z)):
            inside[i] |= words[i][1] > a
    return [words[i] for i in np.flatnonzero(~inside[:-1]).tolist()]


def _entity(text: str, kind: str, start: int, end: int) -> int:
    return xxhash.xxh64_intdigest(f"{kind}:{text[start:end].lower()}") >> 1


def _near(text: str, spans: list[tuple[str, int, int]]) -> dict[tuple[int, str], set[int]]:
    """The hashes of the contexts in which a term stands near an entity."""
    free = _free_words(text, spans)
    starts = [a for a, _ in free]
    names: dict[str, str] = {}
    lower = [names.setdefault(w, w) for w in (text[a:z].translate(_LOWER) for a, z in free)]
    found: dict[tuple[int, str], set[int]] = {}
    for kind, a, z in spans:
        mid = bisect_left(starts, a)
        around = lower[max(0, mid - CONTEXT) : mid + CONTEXT]
        context = xxhash.xxh64_intdigest(" ".join(around)) >> 1
        entity = _entity(text, kind, a, z)
        for term in set(around):
            found.setdefault((entity, term), set()).add(context)
    return found


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_SPANS_SQL = "array<struct<kind:string, start:int, end:int>>"
_TERMS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("remove", pa.bool_())]))
_TERMS_SQL = "array<struct<start:int, end:int, remove:boolean>>"


def _lists(sizes: list[int], values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), pa.int32()), values)


def _scan(docs: DataFrame) -> DataFrame:
    """(doc_id, key, base, entities, near) for each row."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, entities, sizes = [], [], []
        near: tuple[list, list, list] = ([], [], [])
        for text in batch.column("text").to_pylist():
            spans = find(text) if text else []
            base.append([{"kind": k, "start": a, "end": z} for k, a, z in spans])
            entities.append(list({_entity(text, *x) for x in spans}))
            found = _near(text, spans) if spans else {}
            sizes.append(len(found))
            for (entity, term), contexts in found.items():
                for column, value in zip(near, (entity, term, list(contexts))):
                    column.append(value)
        hashes = Words([x.encode() for x in near[1]]).hashes().view(np.int64)
        fields = [
            pa.array(near[0], pa.int64()), pa.array(near[1], pa.string()), pa.array(hashes),
            pa.array(near[2], pa.list_(pa.int64())),
        ]
        flat = pa.StructArray.from_arrays(fields, ["entity", "term", "hash", "contexts"])
        return pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "key": batch.column("key"),
                "base": pa.array(base, _SPANS),
                "entities": pa.array(entities, pa.list_(pa.int64())),
                "near": _lists(sizes, flat),
            }
        )

    keyed = docs.select("doc_id", "text", row_key().alias("key"))
    near = "array<struct<entity:bigint, term:string, hash:bigint, contexts:array<bigint>>>"
    return map_slices(keyed, make, f"doc_id bigint, key bigint, base {_SPANS_SQL}, entities array<bigint>, near {near}")


def _row_counts(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(term, n_t): rows with a term, for terms that the filter may hold."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def told(counts: Counter) -> pa.RecordBatch:
        terms = pa.array([t.decode() for t in counts], pa.string())
        return pa.record_batch({"term": terms, "n": pa.array(counts.values(), pa.int64())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            words = Words([normal(x, PLAIN) for x in texts(batch)])
            hit = np.flatnonzero(bitmap.may_hold(shared.value, words.hashes()))
            data = words.data.tobytes()
            rows, starts, ends = (x[hit].tolist() for x in (words.row, words.start, words.end))
            seen = {(i, data[a:z]) for i, a, z in zip(rows, starts, ends)}
            counts.update(t for _, t in seen)
            if len(counts) >= HELD_TERMS:
                yield told(counts)
                counts.clear()
        yield told(counts)

    found = docs.select("text").mapInArrow(count, "term string, n bigint")
    return found.groupBy("term").agg(F.sum("n").alias("n_t"))


def _disclosing(docs: DataFrame, scanned: DataFrame, threshold: float, contexts: int) -> DataFrame:
    """(entity, term, share, common) where the term discloses that share of the entity,
    which is common if a hundredth of all rows hold it."""
    near = scanned.select("doc_id", "key", F.explode("near").alias("x")).select("doc_id", "key", "x.*")
    # two mentions in one document, or in copies of one passage, are no evidence
    pairs = near.groupBy("entity", "term", "hash").agg(
        F.count("*").alias("n_et"), F.count_distinct(F.struct("doc_id", "key")).alias("documents")
    )
    spread = near.select("entity", "term", F.explode("contexts").alias("context")).groupBy("entity", "term")
    spread = spread.agg(F.count_distinct("context").alias("contexts"))
    pairs = pairs.filter(F.col("documents") >= 2).join(spread.filter(F.col("contexts") >= contexts), ["entity", "term"])
    pairs = stored(pairs.select("entity", "term", "hash", "n_et"))
    counts = _row_counts(docs, bitmap.build(pairs, "hash"))
    n_e = scanned.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e"))
    n = F.lit(float(scanned.count()))
    pmi = F.log(n * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    facts = pairs.join(counts, "term").join(n_e, "entity").filter(F.col("n_e") < n)
    common = (F.col("n_e") * 100 > n).alias("common")
    facts = facts.select("entity", "term", (pmi / F.log(n / F.col("n_e"))).alias("share"), common)
    return facts.filter(F.col("share") >= threshold)


def _asked(scanned: DataFrame, told: DataFrame, remove: float | None) -> DataFrame:
    """(_d, _k, asked): the terms to look for in each document, and whether they go."""
    goes = (F.col("share") >= remove if remove is not None else F.lit(False)).alias("remove")
    told = stored(told.groupBy("entity", "common").agg(F.collect_list(F.struct("term", goes)).alias("x")))
    held = scanned.select("doc_id", "key", F.explode("entities").alias("entity")).distinct()
    # common entities, about a hundred for each that a row holds, go to every task; the
    # others are too rare to burden one
    common = F.broadcast(told.filter("common"))
    rest = held.join(common.select("entity"), "entity", "left_anti").join(told.filter("not common"), "entity")
    found = held.join(common, "entity").unionByName(rest)
    found = found.select("doc_id", "key", F.explode("x").alias("x")).select("doc_id", "key", "x.*")
    # a term that discloses several entities of a document is removed if one asks for it
    terms = found.groupBy("doc_id", "key", "term").agg(F.max("remove").alias("remove"))
    return terms.groupBy(F.col("doc_id").alias("_d"), F.col("key").alias("_k")).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "remove"))).alias("asked")
    )


def _places(text: str, asked: list[tuple[str, bool]]) -> list[dict]:
    wanted = dict(asked)
    out = []
    for a, z in _free_words(text, find(text)):
        remove = wanted.get(text[a:z].translate(_LOWER))
        if remove is not None:
            out.append({"start": a, "end": z, "remove": remove})
    return out


def spans(docs: DataFrame, threshold: float = GENERALISE, contexts: int = 2, remove: float | None = None) -> DataFrame:
    """(doc_id, key, base, terms) for each row of ``docs`` (doc_id, text).

    ``base`` has the spans found by pattern, by kind and start; ``terms`` all places in
    the text, by start, of terms that disclose ``threshold`` of the information of one of
    its entities, and whether they disclose ``remove`` of it, if set.  A term has to stand near
    the entity in two documents, and in ``contexts`` different contexts.  NULL and empty
    texts have neither.  Equal rows have equal spans, and count as often as they come
    but as one document; a NULL doc_id is a document like any other.

    A text is held whole, with 16 near terms at most for each mention of an entity; terms
    are looked up once for each document, so that all grows with the length of the text.
    """
    scanned = stored(_scan(docs))
    asked = stored(_asked(scanned, _disclosing(docs, scanned, threshold, contexts), remove))
    keyed = docs.select("doc_id", "text", row_key().alias("key"))
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("key") == F.col("_k"))
    # equal rows are read once
    again = keyed.join(asked, on).select("doc_id", "key", "text", F.map_entries("asked").alias("asked"))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(batch.column("text").to_pylist(), batch.column("asked").to_pylist())
        found = [_places(text, [(x["key"], x["value"]) for x in asked]) for text, asked in rows]
        return pa.record_batch({"_d": batch.column("doc_id"), "_k": batch.column("key"), "terms": pa.array(found, _TERMS)})

    terms = map_slices(again, make, f"_d bigint, _k bigint, terms {_TERMS_SQL}").dropDuplicates(["_d", "_k"])
    none = F.array().cast(_TERMS_SQL)
    return scanned.select("doc_id", "key", "base").join(terms, on, "left").select(
        "doc_id", "key", "base", F.coalesce("terms", none).alias("terms")
    )


def written(found: str | Column, kind: Column | None = None) -> Column:
    """Spans as text, kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(
            found,
            lambda x: F.concat_ws(
                ":", x["kind"] if kind is None else kind, x["start"].cast("string"), x["end"].cast("string")
            ),
        ),
        ",",
    )


def sanitised(text: str, found: list[tuple[int, int, str]]) -> str:
    """``text`` with each span replaced by its kind in brackets, or removed for the kind "".

    Overlapping spans are one, of the kind that starts first.
    """
    parts, at = [], 0
    open_to = -1
    for start, end, kind in sorted(found):
        if start < open_to:
            open_to = max(open_to, end)
        else:
            parts += [text[at:start] if at <= start else "", f"[{kind.upper()}]" if kind else ""]
            open_to = end
        at = open_to
    return "".join([*parts, text[at:]])


def sanitise(docs: DataFrame, threshold: float = GENERALISE, contexts: int = 2, remove: float | None = None) -> DataFrame:
    """``docs`` with personal data in text generalised, and the terms that disclose it
    generalised or removed (see :func:`spans`)."""
    found, key = free(docs, "pii_spans"), free(docs, "pii_key")
    told = spans(docs, threshold, contexts, remove).filter("size(base) > 0").dropDuplicates(["doc_id", "key"])
    term = F.transform(
        "terms",
        lambda x: F.struct(
            F.when(x["remove"], "").otherwise(TERM).alias("kind"), x["start"].alias("start"), x["end"].alias("end")
        ),
    )
    told = told.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), F.concat("base", term).alias(found))
    keyed = docs.withColumn(key, row_key())
    on = docs["doc_id"].eqNullSafe(told["d"]) & (keyed[key] == told["k"])
    joined = keyed.join(told, on, "left").select(*(keyed[f"`{c}`"] for c in docs.columns), told[found])
    names = docs.columns

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, found_here in zip(batch.column("text").to_pylist(), batch.column(found).to_pylist()):
            if text and found_here:
                text = sanitised(text, [(x["start"], x["end"], x["kind"]) for x in found_here])
            out.append(text)
        columns = {c: batch.column(c) for c in names}
        return pa.record_batch(columns | {"text": pa.array(out, pa.string())})

    return map_slices(joined, make, docs.schema)
