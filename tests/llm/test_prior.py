"""The class prior from positives and unlabelled text, and the model against a plain version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.llm import quality

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("share", [0.1, 0.5, 0.85])
def test_prior_of_a_planted_mixture(share):
    rng = np.random.default_rng(5)
    good = rng.normal(0.6, 0.4, 5000)
    n = 40_000
    mixed = np.where(rng.random(n) < share, rng.normal(0.6, 0.4, n), rng.normal(-0.8, 0.3, n))
    bins = [np.bincount(quality.prior_bins(np.rint(x * quality._UNIT)[:, None], np.array([quality.SCALE])), minlength=quality.PRIOR_BINS) for x in (good, mixed)]
    assert quality.class_prior(*bins) == pytest.approx(share, abs=0.05)


def test_prior_where_all_text_is_good_or_alike():
    same = np.bincount(np.arange(quality.PRIOR_BINS), minlength=quality.PRIOR_BINS)
    assert quality.class_prior(same, same) == 1
    one = np.zeros(quality.PRIOR_BINS, np.int64)
    one[3] = 7
    assert quality.class_prior(one, one) == 1


def test_negative_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    good = labels.filter("quality = 1")
    assert quality.fit(docs, labels) == quality.fit(docs, good)
    n, ones = labels.count(), good.count()
    assert quality.labelled_share(labels) == pytest.approx(ones / n)
    assert quality.labelled_share(labels.limit(0)) is None
    assert quality.fit(docs, labels, prior=0.25).prior == 0.25


def test_model_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    twice = docs.unionByName(docs.filter("doc_id % 5 = 0")).unionByName(docs.limit(1).withColumn("text", F.lit(None).cast("string")))
    rows, good = twice.collect(), {r.doc_id for r in labels.collect() if r.quality == 1}
    x = quality.features([r.text.encode() if r.text is not None else None for r in rows])
    p = x[[r.doc_id in good for r in rows]]
    means = []
    for part in (p, x):
        part = part / quality.SCALE
        means += [part.mean(axis=0), sum(np.outer(v, v) for v in part) / len(part)]
    w = quality.separating_weights(*means)
    score = [[int(sum(int(a) * int(b) for a, b in zip(v, w))) for v in part] for part in (p, x)]
    best = (np.inf, None)
    for cut in range(quality.PRIOR_BINS):
        above = [np.mean([(s / (quality._UNIT * quality.SCALE) + 1) / 2 * quality.PRIOR_BINS >= cut or cut == 0 for s in part]) for part in score]
        if above[0]:
            doubt = np.sqrt(np.log(40) / 2) * (len(p) ** -0.5 + len(x) ** -0.5)
            best = min(best, ((above[1] + 1.01 * doubt) / above[0], -cut, above[1] / above[0]))
    model = quality.fit(twice, labels)
    assert model.prior == pytest.approx(np.clip(best[-1], 0.05, 0.95))
    assert model.weights == pytest.approx(quality.non_negative_weights(model.prior, *means), abs=1e-6)
    scored = quality.score(twice, model).collect()
    want = {(r.doc_id, r.text): v for r, v in zip(rows, np.clip((x / quality.SCALE @ np.array(model.weights) + 1) / 2, 0, 1))}
    assert len(scored) == len(rows)
    for r in scored:
        assert r.score == pytest.approx(want[r.doc_id, r.text], abs=1e-9)
