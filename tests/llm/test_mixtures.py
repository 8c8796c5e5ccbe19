"""Language mixtures against a plain version that tries every set, and many languages."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.llm import language

SMALL = "/root/testdata/sf0.001"


def _plain_words(text):
    low = (text or "").lower().encode()
    return bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in low).split()


def _bins(word):
    wide = b" " + word + b" "
    return [(int.from_bytes(wide[i : i + 3], "big") * 2654435761) % 2**32 >> 16 for i in range(len(word))]


def _plain_fit(rows):
    counts = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(b for w in _plain_words(text) for b in _bins(w))
    return {k: c for k, c in sorted(counts.items()) if c}


def _plain_predict(counts, text):
    """The proportions of the best set, all sets in the order of the proportions tried."""
    words, langs = _plain_words(text), list(counts)
    logs = []
    for w in words:
        total = [c.total() + language.BINS / 2 for c in counts.values()]
        logs.append([sum(math.log((c[b] + 0.5) / t) for b in _bins(w)) for c, t in zip(counts.values(), total)])

    def fitted(some):
        pi = {l: 1 / len(some) for l in some}
        for _ in range(language.STEPS):
            new = dict.fromkeys(some, 0.0)
            for row in logs:
                top = max(row)
                part = {l: pi[l] * math.exp(row[l] - top) for l in some}
                for l in some:
                    new[l] += part[l] / sum(part.values()) / len(words)
            pi = new
        return pi, sum(max(r) + math.log(sum(pi[l] * math.exp(r[l] - max(r)) for l in some)) for r in logs)

    k, price = len(langs), math.log(len(words)) / 2
    pi, value = fitted(range(k))
    order = sorted(range(k), key=lambda l: -pi[l])
    best, best_value = pi, value - price * (k - 1)
    for size in range(1, k):
        some, some_value = fitted(order[:size])
        if some_value - price * (size - 1) > best_value:
            best, best_value = some, some_value - price * (size - 1)
    return {langs[l]: x for l, x in best.items() if x > 0}


def test_mixtures_are_those_of_a_plain_search(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    train = docs.filter("doc_id % 2 = 0")
    counts = _plain_fit([(r.text, r.lang) for r in train.collect()])
    model = language.fit(train)
    assert model.languages == tuple(counts)
    parts = [r.text for r in docs.filter("doc_id % 2 = 1 and length(text) between 40 and 900").orderBy("doc_id").collect()]
    mixed = [" ".join(a.split()[:40] + b.split()[: 3 + i]) for i, (a, b) in enumerate(zip(parts, parts[7:]))]
    texts = [*parts[:40], *mixed[:40], "the", "the the the the", "Ein Äpfel 7 the", "12 !!", "", None]
    names, scores, shares = model.predict(texts)
    sizes = set()
    for text, name, score, share in zip(texts, names, scores, shares):
        if not re.search(r"[^\W\d_]", text or ""):
            assert (name, score, share) == ("und", 0, {})
            continue
        want = _plain_predict(counts, text)
        assert name == max(want, key=want.get), text
        assert share == pytest.approx(want, abs=1e-6), text
        assert score == pytest.approx(want[name], abs=1e-6)
        sizes.add(len(want))
    assert sizes >= {1, 2}


def test_slices_do_not_change_a_prediction(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text", "lang")
    model, texts = language.fit(docs), [r.text for r in docs.collect()]
    whole = model.predict(texts)
    monkeypatch.setattr(language, "CELLS", 500)
    parts = model.predict(texts)
    assert parts[0] == whole[0]
    assert parts[1] == pytest.approx(whole[1], abs=1e-9)


def test_counts_given_out_early_are_the_same(spark, monkeypatch):
    counts, rng = language._Counts(), np.random.default_rng(1)
    want = Counter()
    for _ in range(50):
        bins, n = np.unique(rng.integers(0, 99, 20), return_counts=True)
        counts.add("x", bins, n)
        want.update(dict(zip(bins.tolist(), n.tolist())))
    (batch,) = counts.taken()
    assert dict(zip(batch["bin"].to_pylist(), batch["n"].to_pylist())) == want and counts.size == 0


def test_a_dirty_language_column_stays_small(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text", "lang").filter("length(text) < 600")
    dirty = docs.limit(60).withColumn("lang", F.concat("lang", F.lit("?"), F.monotonically_increasing_id()))
    rows = [tuple(r) for r in docs.unionByName(dirty).collect()]
    counts = _plain_fit(rows)
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == tuple(counts) and len(counts) > 20
    # an entry for each n-gram that a language has, instead of BINS for each language
    assert len(model.language) == len(model.above) == sum(map(len, counts.values()))
    found = language.identify(docs, model)
    assert found.filter("lang_pred is null").count() == 0


def test_no_language(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    model = language.fit(empty)
    assert model.predict(["a text", None]) == (["und", "und"], pytest.approx([0, 0]), [{}, {}])
