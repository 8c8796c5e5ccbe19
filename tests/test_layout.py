"""Lengths, packing, batches, sessions and samples."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from loomset import (
    calibration_sample,
    cap_preference_lengths,
    length_grouped_batches,
    pack_sequences,
    packed_tokens,
    python_tokenizer,
    read_session,
    read_sessions,
    session_slices,
    token_counts,
    truncate_to_length,
    truncated_text,
    write_sessions,
)
from loomset.functions import BLANKS, split_tokens, token_slice
from loomset.operators import global_ranks, sums_before
from verify.queries import QUERIES

COUNTS = "row_id bigint, n_tokens int"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _packed(rows, length, separators=1, keep_last=True):
    """Spans, and the sequences as lists of (row, token); -1 is a separator."""
    stream = [(r, t if t < n else -1) for r, n in sorted(rows) for t in range((n or 0) + separators)]
    cut = [stream[i : i + length] for i in range(0, len(stream), length)]
    if not keep_last and cut and len(cut[-1]) < length:
        cut.pop()
    spans = set()
    at = 0
    for r, n in sorted(rows):
        size = (n or 0) + separators
        for seq in {p // length for p in range(at, at + size)}:
            low, high = max(at, seq * length), min(at + size, (seq + 1) * length)
            if seq < len(cut):
                spans.add((seq, r, low - at, high - at, low - seq * length))
        at += size
    return spans, cut


@pytest.mark.parametrize("length", [1, 7, 50])
@pytest.mark.parametrize("separators, keep_last", [(1, True), (0, True), (2, False)])
def test_packed_spans_tile_the_stream(spark, length, separators, keep_last):
    random.seed(length)
    rows = [(i * 3, random.choice([0, 1, 2, 5, 30])) for i in range(60)] + [(91, 900), (1000, 3)]
    df = spark.createDataFrame(rows, COUNTS).repartition(5)
    got = pack_sequences(df, length, separators=separators, keep_last=keep_last)
    assert got.columns == ["seq_id", "row_id", "tok_from", "tok_to", "seq_from"]
    want, _ = _packed(rows, length, separators, keep_last)
    assert _rows(got) == sorted(want, key=repr)


def test_packing_edges(spark):
    assert pack_sequences(spark.createDataFrame([], COUNTS), 8).count() == 0
    assert pack_sequences(spark.createDataFrame([], COUNTS), 8, keep_last=False).count() == 0
    odd = spark.createDataFrame([(None, 2), (1, None), (2, 3)], COUNTS)
    assert _rows(pack_sequences(odd, 4)) == _rows(pack_sequences(odd.orderBy(F.desc("row_id")), 4))
    assert pack_sequences(odd, 100).agg(F.sum(F.col("tok_to") - F.col("tok_from"))).first()[0] == 8
    copies = spark.createDataFrame([(1, 4), (1, 4), (2, 1)], COUNTS)
    assert pack_sequences(copies, 3).agg(F.sum(F.col("tok_to") - F.col("tok_from"))).first()[0] == 12
    for bad in (0, -1, 2.5, True):
        with pytest.raises(ValueError, match="length"):
            pack_sequences(copies, bad)
    with pytest.raises(ValueError, match="separators"):
        pack_sequences(copies, 3, separators=-1)


def test_packed_tokens_are_the_stream(spark):
    rows = [(1, "a b c"), (2, ""), (3, "d"), (4, "e " * 40 + "f")]
    df = spark.createDataFrame(rows, "row_id bigint, text string").repartition(3)
    counted = token_counts(df)
    spans = pack_sequences(counted.select("row_id", "n_tokens"), 8)
    tokens = df.select("row_id", split_tokens(F.col("text")).alias("tokens"))
    got = [r.tokens for r in packed_tokens(spans, tokens, F.lit("|")).orderBy("seq_id").collect()]
    stream = [t for _, text in rows for t in [*(text.split(" ") if text else []), "|"]]
    assert got == [stream[i : i + 8] for i in range(0, len(stream), 8)]


def test_no_window_sees_all_rows(spark):
    df = spark.range(0, 1000, numPartitions=4).select(F.col("id").alias("row_id"), F.lit(3).alias("n_tokens"))
    for result in (pack_sequences(df, 16), length_grouped_batches(df, 8)):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if "Window [" in line]
        # the one without a partition is over one row for each range or bucket
        assert sum("row_id" in line and "windowspecdefinition(__loomset" in line for line in windows) >= 1
        assert not any("row_id" in line and "windowspecdefinition(row_id" in line for line in windows)


@pytest.mark.parametrize("limit", [1, 10, 1_000_000])
def test_ranks_of_crowded_keys(spark, limit):
    random.seed(5)
    # a third of the keys share all but their last bytes, and some are prefixes of others
    keys = [b"same" * 6 + i.to_bytes(2, "big") for i in range(150)] + [random.randbytes(6) for _ in range(300)]
    keys += [b"same", b"same" * 6, b"sa", b"s", b""]
    df = spark.createDataFrame([(k,) for k in keys], "key binary").repartition(4)
    got = {bytes(r.key): r["rank"] for r in global_ranks(df, "key", max_bucket_rows=limit).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_equal_keys_have_one_rank_each(spark):
    df = spark.createDataFrame([(b"xx",)] * 30 + [(b"a",)], "key binary")
    assert sorted(r["rank"] for r in global_ranks(df, "key", max_bucket_rows=4).collect()) == list(range(31))


def test_sums_before(spark):
    rows = [(i, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "row_id bigint, n bigint").repartition(6)
    got = {r.row_id: r.before for r in sums_before(df, "row_id", "n").collect()}
    assert got == {i: sum(n for _, n in rows[:i]) for i, _ in rows}


def _batches(rows, size, groups, seed=42):
    ranked = sorted(rows, key=lambda r: hashlib.md5(f"{seed}:{r[0]}".encode()).digest())
    out = []
    for g in range(0, len(ranked), size * groups):
        inside = sorted(ranked[g : g + size * groups], key=lambda r: (-(r[1] or 0), r[0]))
        out += [(r[0], g // size + i // size) for i, r in enumerate(inside)]
    return sorted(out)


def test_batches(spark):
    random.seed(6)
    rows = [(i, random.choice([1, 5, 9, None])) for i in range(333)]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, COUNTS).repartition(parts)
        assert _rows(length_grouped_batches(df, 4, batches_per_group=5)) == sorted(_batches(rows, 4, 5), key=repr)
    assert length_grouped_batches(spark.createDataFrame([], COUNTS), 4).count() == 0
    copies = spark.createDataFrame([(1, 2)] * 9 + [(None, 2)] * 3, COUNTS)
    counts = length_grouped_batches(copies, 4).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in counts) == [4, 4, 4]


def test_sessions_are_read_alone(spark, tmp_path):
    df = spark.range(0, 300, numPartitions=3).select(F.col("id").alias("row_id"), (F.col("id") % 9).alias("n_tokens"))
    spans = pack_sequences(df, 16)
    sessions = session_slices(spans, effective_batch=2, max_steps=5)
    path = str(tmp_path / "sessions")
    write_sessions(sessions, path)
    n = spans.agg(F.max("seq_id")).first()[0] // 10 + 1
    parts = [read_session(spark, path, i) for i in range(n)]
    seqs = [{r.seq_id for r in p.collect()} for p in parts]
    assert all(s == set(range(i * 10, min(i * 10 + 10, max(seqs[-1]) + 1))) for i, s in enumerate(seqs))
    assert sum(p.count() for p in parts) == spans.count()
    plan = parts[1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_id" in plan
    files = {r[0] for r in parts[1].select(F.input_file_name()).distinct().collect()}
    assert files and all("/session_id=1/" in f for f in files)


def test_sessions_are_read_in_one_scan(spark, tmp_path):
    sessions = session_slices(spark.range(0, 300).select(F.col("id").alias("seq_id")), effective_batch=2, max_steps=5)
    path = str(tmp_path / "sessions")
    write_sessions(sessions, path)
    asked = {(0, None): range(30), (7, 21): range(7, 22), (29, 40): [29], (30, None): []}
    for (first, last), there in asked.items():
        rows = read_sessions(spark, path, first, last)
        one_by_one = [r for i in there for r in read_session(spark, path, i).collect()]
        assert _rows(rows) == sorted(map(tuple, one_by_one), key=repr) and len(one_by_one) == 10 * len(there)
    plan = read_sessions(spark, path, 7, 21)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_id" in plan and plan.count("FileScan") == 1


def test_session_query_reads_its_sessions_at_once(spark, tmp_path):
    docs = spark.range(0, 6).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 100_000).alias("text"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["session_slices"](spark, str(tmp_path))
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    ends = got.groupBy("session_id").agg(F.min("step"), F.max("step"), F.sum(F.col("tok_to") - F.col("tok_from")))
    # 100,001 tokens and a separator a document
    total = 6 * 100_002
    assert _rows(ends) == [(i, i * 100, min(i * 100 + 99, (total - 1) // 1024), min(total - i * 102_400, 102_400)) for i in range(6)]


def test_samples_do_not_depend_on_the_files(spark):
    rows = [(i % 400, f"text {i % 90}", "abc"[i % 3]) for i in range(1200)]
    schema = "row_id bigint, text string, lang string"
    one = spark.createDataFrame(rows, schema).repartition(1)
    many = spark.createDataFrame(rows[::-1], schema).repartition(7)
    assert _rows(calibration_sample(one, 25)) == _rows(calibration_sample(many, 25))
    by = [calibration_sample(df, 10, by=("lang",)) for df in (one, many)]
    assert _rows(by[0]) == _rows(by[1]) and by[0].columns == ["row_id", "text", "lang"]
    assert {r["count"] for r in by[0].groupBy("lang").count().collect()} == {10}
    assert _rows(calibration_sample(one, 25, seed=1)) != _rows(calibration_sample(one, 25))
    assert calibration_sample(one, 5000).count() == 1200
    plan = calibration_sample(one, 25)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange rangepartitioning" not in plan


def test_truncation(spark):
    rows = [(1, "a b c d"), (2, "a b"), (3, ""), (4, None), (5, " x  y ")]
    df = token_counts(spark.createDataFrame(rows, "row_id bigint, text string"))
    got = {
        r.row_id: (r.n_tokens, r.kept_tokens, r.was_truncated, r.out)
        for r in truncate_to_length(df, 3).withColumn("out", truncated_text(F.col("text"), F.col("kept_tokens"))).collect()
    }
    assert got[1] == (4, 3, True, "a b c") and got[2] == (2, 2, False, "a b")
    assert got[3] == (0, 0, False, "") and got[4][:3] == (0, 0, False) and got[5] == (5, 3, True, " x ")


def test_preference_budget(spark):
    schema = "row_id int, n_prompt int, n_chosen int, n_rejected int"
    rows = [(1, 50, 10, 200), (2, 0, 0, 0), (3, 4, 3, 2), (4, None, 90, None), (5, 10, 71, 70)]
    got = {
        r.row_id: (r.prompt_from, r.prompt_to, r.chosen_to, r.rejected_to, r.was_capped)
        for r in cap_preference_lengths(spark.createDataFrame(rows, schema), max_length=80, max_prompt_length=20).collect()
    }
    assert got[1] == (30, 50, 10, 60, True)
    assert got[2] == (0, 0, 0, 0, False)
    assert got[3] == (0, 4, 3, 2, False)
    assert got[4] == (0, 0, 80, 0, True)
    assert got[5] == (0, 10, 70, 70, True)
    with pytest.raises(ValueError, match="below"):
        cap_preference_lengths(spark.createDataFrame(rows, schema), max_length=80, max_prompt_length=80)


TEXTS = [(1, "a b  c"), (2, None), (3, ""), (4, "é 日"), (5, "x" * 3_000_000), (6, "y z")]


def test_python_tokenizer(spark):
    df = spark.createDataFrame(TEXTS, "row_id bigint, text string").repartition(1)

    def lengths(texts):
        assert texts and all(texts)
        return [[len(w) for w in t.split(" ")] for t in texts]

    called = python_tokenizer(lengths)
    rows = token_counts(token_counts(df), called, into="n").withColumn("ids", called.tokens(F.col("text")))
    got = {r.row_id: (r.n_tokens, r.n, r.ids) for r in rows.collect()}
    assert got[1] == (4, 4, [1, 1, 0, 1]) and got[2] == (0, 0, []) and got[3] == (0, 0, [])
    assert got[4] == (2, 2, [1, 1]) and got[5] == (1, 1, [3_000_000])
    assert BLANKS.tokens is split_tokens


@pytest.mark.parametrize("wrong", [lambda t: [[1]] * (len(t) + 1), lambda t: None, lambda t: [["x"]] * len(t)])
def test_a_tokenizer_that_breaks_its_contract_ends_the_job(spark, wrong):
    df = spark.createDataFrame([(1, "a b")], "row_id bigint, text string")
    with pytest.raises(Exception, match="rows of ids|invalid|int|convert"):
        df.select(python_tokenizer(wrong).tokens(F.col("text"))).collect()


def test_token_slice(spark):
    df = spark.createDataFrame([("a b c d",)], "text string")
    cuts = [(0, 2), (1, 3), (3, 9), (4, 4), (2, 1)]
    row = df.select(*(token_slice(F.col("text"), a, z) for a, z in cuts)).first()
    assert list(row) == ["a b", "b c", "d", "", ""]
