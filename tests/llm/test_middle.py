"""Fill-in-the-middle rows against plain Python, and the way back."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomset.llm import middle

SCHEMA = "doc_id bigint, text string"


def test_rank_select_and_code_points():
    random.seed(0)
    for _ in range(500):
        rows = ["".join(random.choices("a\né日\x0b\x8a𝄞", k=random.randint(0, 30))) for _ in range(5)]
        parts = [x.encode() for x in rows]
        sizes = np.array([len(x) for x in parts], np.int64)
        ends = np.cumsum(sizes)
        units = middle.Units(b"".join(parts), ends - sizes, ends)
        split = [re.findall(r"[^\n]*\n|[^\n]+", x) for x in rows]
        assert units.count.tolist() == [len(x) for x in split]
        k = np.array([random.randint(0, len(x)) for x in split])
        at = units.end_of(k)
        heads = ["".join(x[:i]) for x, i in zip(split, k)]
        assert (at - units.starts).tolist() == [len(x.encode()) for x in heads]
        assert units.chars(units.starts, at).tolist() == [len(x) for x in heads]


def test_every_byte_is_judged_on_its_own():
    words = np.frombuffer(np.random.default_rng(0).integers(0, 256, 8000, np.uint8).tobytes(), "<u8")
    for byte in (0, 9, 10, 11, 127):
        marks = middle.equal_bytes(words, byte).view(np.uint8)
        assert ((marks == 0x80) == (words.view(np.uint8) == byte)).all() and set(marks) <= {0, 0x80}


def plain(doc_id, text, percent, spm):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return len(units), "plain", None, None, text
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("percent, spm", [(100, 50), (60, 0), (0, 100)])
def test_plain_python(spark, percent, spm):
    random.seed(4)
    parts = ["a", "<", "S>", "<P", "\n", "\n\n", "é", "日本", "𝄞", " ", "\r", "\x00"]
    rows = [(i, "".join(random.choices(parts, k=random.randint(0, 40)))) for i in range(600)]
    rows += [(1, rows[1][1]), (None, "a\nb\n"), (None, None), (5, None), (9001, "<M>"), (9002, "x\n" * 300_000), (9003, "é" * 700_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    # columns of the same names go, others stay
    df = df.withColumn("Form", F.lit("mine")).withColumn("fim_hashes", F.lit("kept")).withColumn("a.b", F.lit(1))
    done = middle.fill_in_middle(df, percent=percent, percent_spm=spm).withColumn("back", middle.restored())
    assert {"fim_hashes", "a.b"} <= set(done.columns) and "Form" not in done.columns
    got = sorted(map(tuple, done.select("doc_id", "text", "n_units", "form", "prefix_chars", "middle_chars", "output", "back").collect()), key=repr)
    assert got == sorted(((i, t, *plain(i, t, percent, spm), t or "") for i, t in rows), key=repr)


def test_empty_table_and_another_ending(spark):
    assert middle.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
    done = middle.fill_in_middle(spark.createDataFrame([(1, "a.b.c")], SCHEMA), ending=".").first()
    assert done.n_units == 3 and sorted(done.output.replace("<P>", "").replace("<S>", "").replace("<M>", "")) == sorted("a.b.c")
    with pytest.raises(ValueError):
        middle.fill_in_middle(spark.createDataFrame([], SCHEMA), ending="é")
