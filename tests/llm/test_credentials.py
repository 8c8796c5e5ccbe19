"""Secrets against plain Python: places, overlaps and owners."""

import random
import re

from pyspark.sql import functions as F

from loomset.llm import credentials

SCHEMA = "doc_id bigint, text string, repository string, owner string"
KINDS = {
    "assign": r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "(AKIA[A-Z0-9]+)",
    "hex": "([0-9a-f]+)",
    "live": "([A-Za-z0-9+/_=-]+)",
}
LEAST = {"assign": 6, "access": 20, "hex": 24, "live": 20}


def _looks(value):
    return len(set(value)) >= 10 and re.search("[0-9]", value) and re.search("[A-Za-z]", value)


def plain(rows, most_owners=2):
    """For each row: base spans, live spans, examples, live-looking ones of one owner."""
    found, owners = [], {}
    for _, text, _, owner in rows:
        spans = []
        for rank, (kind, pattern) in enumerate(KINDS.items()):
            flags = re.I | re.A if kind == "assign" else 0
            for m in re.finditer(pattern, text or "", flags):
                if kind == "assign" or len(m[1]) >= LEAST[kind]:
                    owners.setdefault(m[1], set()).add(owner)
                if len(m[1]) >= LEAST[kind]:
                    spans.append((m.start(), rank, kind, m.end(), m[1]))
        found.append(sorted(spans))
    out = []
    for spans in found:
        base = [x for x in spans if x[2] != "live"]
        free = [
            x for x in spans
            if x[2] == "live" and _looks(x[4]) and not any(b[0] < x[3] and x[0] < b[3] for b in base)
        ]
        examples = [x for x in base if len(owners[x[4]]) > most_owners]
        live = [x for x in base if len(owners[x[4]]) <= most_owners and _looks(x[4])]
        own = [x for x in free if len(owners[x[4]]) <= most_owners]
        out.append(([x[:4] for x in base], [x[:4] for x in own], len(examples), len(live)))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("key", F.lit("mine")).withColumn("a.b", F.lit(1))
    got = sorted(
        ((r.doc_id, [tuple(x) for x in r.base], [tuple(x) for x in r.live], r.n_examples, r.n_live) for r in credentials.scan(df).collect()),
        key=repr,
    )
    want = sorted(((row[0], *x) for row, x in zip(rows, plain(rows))), key=repr)
    assert got == want
    return want


def test_plain_python(spark):
    random.seed(3)
    parts = [
        "token", "Token", "=", ":", " ", '"', "'", "API_KEY", "apikey", "password", "AKIA", "ABCDEFGHIJKLMNOP1",
        "0123456789abcdef", "deadbeefdeadbeefdeadbeef01", "é", "日", "𝄞", "\n", "zxcvbnm12345", "Secret", "x-Y_9/a+b", "--",
    ]
    rows = [(i, "".join(random.choices(parts, k=random.randint(0, 25))), f"r{i % 7}", f"o{i % 5}") for i in range(1500)]
    want = check(spark, rows)
    assert sum(len(x[2]) for x in want) > 100 and sum(x[3] for x in want) > 100 and sum(x[4] for x in want) > 50


def test_owners_tell_examples_from_live_keys(spark):
    copied, own = "abcDEF123456ghiJKL7890xyz", "Qq7Zz1Xx5Ww9Vv3Uu8Tt2Ss6R"
    rows = [(i, f"see {copied} here", f"r{i}", f"o{i % 4}") for i in range(40)]
    rows += [(100 + i, f"see {own} here", f"r{i}", "o1") for i in range(40)]
    found = {r.doc_id: [tuple(x) for x in r.live] for r in credentials.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(found[i] == [] for i in range(40))
    assert all(found[100 + i] == [(4, 3, "live", 29)] for i in range(40))


def test_nulls_repeats_and_many_matches(spark):
    key = "ab12cd34ef56ab12cd34ef56"
    many = "\n".join(f'token = "{i:08d}x"' for i in range(20_000))
    rows = [
        (1, f"x {key}", "r", "o"), (1, f"x {key}", "r", "o"), (1, f"xé {key}", "r", None), (None, key, None, None),
        (None, None, None, None), (2, None, "r", "o"), (3, "", "r", "o"), (4, "token=", "r", "o"),
        (5, "token:token:abcdefgh", "r", "o"), (6, "a" * 200_000, "r", "o"), (7, "token " * 30_000, "r", "o"), (8, many, "r", "o"),
    ]
    check(spark, rows)
    assert credentials.scan(spark.createDataFrame([], SCHEMA)).count() == 0
