"""Hard negatives against brute force; rows that take no part, ties, and other dimensions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_force(rows, positives=5, negatives=10):
    kept = set()
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            kept.add((i, label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a in kept:
        if a[0] % 100:
            continue
        met = [(-_dot(a[2], b[2]), b[0], b[1]) for b in kept if b != a and len(b[2]) == len(a[2])]
        for score, positive, _ in sorted(x for x in met if x[2] == a[1])[:positives]:
            inside = [x for x in met if x[2] != a[1] and 30 * -score <= 100 * -x[0] <= 90 * -score]
            for rank, (s, i, _) in enumerate(sorted(inside)[:negatives], 1):
                out.append((a[0], positive, rank, i, -score, -s))
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, negatives.hard_negatives(df, F.expr("vec_id % 100 = 0"), F.col("label")).collect()))


def some_rows(n=420):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        v = np.float32(rng.normal(size=6) * 10.0 ** rng.integers(-2, 2)).tolist()
        # a third of the rows are copies of a few vectors, so that scores tie
        rows.append((i, rows[int(rng.integers(0, 10))][1] if i % 3 == 0 and i > 30 else v, int(rng.integers(0, 4))))
    odd = [
        (7, rows[7][1], rows[7][2]),  # the same row again
        (300, rows[9][1], 3),  # another row of one id
        (-5, [1.0, 2.0], 1),  # other dimensions
        (-100, [], 1),
        (-101, [], 1),
        (-102, [], 0),
        (-200, [0.0] * 6, 1),
        (None, rows[1][1], 1),
        (-300, None, 1),
        (-400, rows[1][1], None),
        (-500, [float("nan")] * 6, 1),
        (-600, [float("inf")] * 6, 1),
        (-700, [None] * 6, 1),
    ]
    return rows + odd


@pytest.mark.parametrize("block, seed", [(8192, 2048), (60, 30)])
def test_brute_force(spark, monkeypatch, block, seed):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "SEED_ROWS", seed)
    rows = some_rows()
    want = brute_force(rows)
    assert len(want) > 100
    assert found(spark, rows) == want


def test_empty_table_and_anchors_without_partners(spark):
    assert found(spark, []) == []
    assert found(spark, [(100, [1.0], 1), (1, [1.0], 2)]) == []


def test_vectors_whose_scores_would_not_fit_take_no_part(spark):
    rows = [(100, [1e30, 0.0], 1), (0, [1e6, 1.0], 1), (1, [1e6, 2.0], 1), (2, [5e5, 0.0], 2)]
    got = found(spark, rows)
    assert got == brute_force(rows[1:])
    assert [r[:4] for r in got] == [(0, 1, 1, 2)]


def test_no_row_that_reaches_is_pruned():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    v = rng.integers(-300, 300, (500, 8)) * rng.integers(0, 2, (500, 8))
    table = pa.table(
        {
            "vec_id": pa.array(range(500)), "row": pa.array(range(500)), "label": pa.array([0] * 500),
            "v": pa.array(v.tolist(), pa.list_(pa.int64())), "square": pa.array((v.astype(float) ** 2).sum(1)),
        }
    )
    block, pruned = negatives.Block(table, 8), 0
    for anchor in v[:40]:
        scores = v @ anchor
        for least in (int(np.sort(scores)[-5]), int(scores.max()), 1, 0, -10):
            may = set(block.reaching(anchor, float((anchor**2).sum()) ** 0.5, least).tolist())
            assert set(np.flatnonzero(scores >= least).tolist()) <= may
            pruned += 500 - len(may)
    assert pruned > 10_000
