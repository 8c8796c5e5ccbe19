"""The exact split, against a plain sort in Python."""

import hashlib
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomset import holdout_split
from loomset.operators.split import find_cut


def expected_eval(rows, fraction, seed=42):
    """rows: (id, key).  Ids of the held-out rows."""
    order = sorted(rows, key=lambda r: (hashlib.md5(f"{seed}:{r[1]}".encode()).hexdigest(), r[0]))
    return {r[0] for r in order[: math.ceil(fraction * len(rows))]}


def run(spark, rows, fraction, **kwargs):
    df = spark.createDataFrame(rows, "id bigint, key string").repartition(5)
    got = holdout_split(df, fraction, "key", tie_break=F.col("id"), **kwargs).collect()
    assert len(got) == len(rows)
    return {r.id for r in got if r.split == "eval"}


@pytest.mark.parametrize("fraction", [0.001, 0.05, 0.07, 0.5, 0.99])
def test_matches_sorting(spark, fraction):
    rows = [(i, f"k{i}") for i in range(1000)]
    assert run(spark, rows, fraction) == expected_eval(rows, fraction)


def test_seed_changes_the_choice(spark):
    rows = [(i, f"k{i}") for i in range(200)]
    assert run(spark, rows, 0.2, seed=7) == expected_eval(rows, 0.2, seed=7)
    assert run(spark, rows, 0.2, seed=7) != run(spark, rows, 0.2)


@pytest.mark.parametrize("fraction", [0.1, 0.3, 0.5, 0.6, 0.9])
def test_a_third_of_all_rows_are_copies(spark, fraction):
    """A tiny bucket limit forces the search through hash and tie-break digits."""
    rows = [(i, "copy" if i % 3 == 0 else f"k{i}") for i in range(900)]
    want = expected_eval(rows, fraction)
    assert run(spark, rows, fraction, max_bucket_rows=1) == want
    assert run(spark, rows, fraction) == want


def test_all_rows_are_copies(spark):
    rows = [(i * 100_000, "same") for i in range(300)]
    assert run(spark, rows, 0.25, max_bucket_rows=10) == expected_eval(rows, 0.25)


def test_repeated_key_without_tie_break_is_refused_when_it_matters(spark):
    df = spark.createDataFrame([(i, "same") for i in range(10)], "id bigint, key string")
    for limit in (1, 1000):
        with pytest.raises(ValueError, match="tie_break"):
            holdout_split(df, 0.5, "key", max_bucket_rows=limit)


def test_no_rows_for_training(spark):
    with pytest.raises(ValueError, match="no training rows"):
        run(spark, [(1, "a")], 0.5)
    with pytest.raises(ValueError, match="empty"):
        find_cut(spark.createDataFrame([], "split_key binary"), 0.5)


def test_no_split(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, key string")
    assert [r.split for r in holdout_split(df, 0.0, "key").collect()] == ["train", "train"]
    for fraction in (-0.1, 1.0, 2):
        with pytest.raises(ValueError):
            holdout_split(df, fraction, "key")


def test_assigning_the_split_needs_no_shuffle(spark):
    df = spark.range(1000)
    plan = holdout_split(df, 0.1, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Join" not in plan


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    keys=st.lists(st.sampled_from("abcdefgh"), min_size=2, max_size=40),
    fraction=st.sampled_from([0.05, 0.3, 0.5]),
    limit=st.sampled_from([1, 3, 100]),
)
def test_any_keys(spark, keys, fraction, limit):
    rows = list(enumerate(keys))
    assert run(spark, rows, fraction, max_bucket_rows=limit) == expected_eval(rows, fraction)


def test_null_keys_count(spark):
    rows = [(i, None if i % 2 else f"k{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "id bigint, key string")
    got = holdout_split(df, 0.1, "key", tie_break=F.col("id")).collect()
    assert sum(r.split == "eval" for r in got) == 10 and len(got) == 100


@pytest.mark.parametrize("tie", ["x", 1.5])
def test_tie_break_is_a_whole_number(spark, tie):
    with pytest.raises(ValueError, match="tie_break"):
        holdout_split(spark.range(10), 0.5, "id", tie_break=F.lit(tie))
