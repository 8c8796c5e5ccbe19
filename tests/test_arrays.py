"""JSON arrays cut by many tasks, against the json module."""

import json
import random

import pytest
from pyspark.sql import functions as F

from loomset import ReadOptions, load_dpo_dataset, load_text_corpus, to_preference_examples
from loomset.operators import codes
from loomset.sources import scan_json, scan_json_texts


def _value(r, depth=0):
    kind = r.random()
    if depth > 3 or kind < 0.4:
        parts = ['"', "\\", "}", "{", "[", "]", ",", "a", "é", "𝄞", " ", "\n", "\\\\", '\\"']
        return "".join(r.choices(parts, k=r.randint(0, 12)))
    if kind < 0.5:
        return r.choice([1, -2.5, None, True, "", [], {}])
    if kind < 0.7:
        return [_value(r, depth + 1) for _ in range(r.randint(0, 4))]
    return {f"k{i}{_value(r, 9)}": _value(r, depth + 1) for i in range(r.randint(0, 4))}


@pytest.fixture()
def small_splits(spark):
    """Splits of 64 bytes, so that an element lies in many of them."""
    names = {"spark.sql.files.maxPartitionBytes": "64b", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _texts(df):
    return sorted(r.value for r in df.collect())


@pytest.mark.parametrize("indent", [None, 1])
def test_elements_across_splits(spark, tmp_path, small_splits, indent):
    r = random.Random(7)
    want = []
    for i in range(6):
        values = [_value(r) for _ in range(r.choice([0, 1, 25]))]
        (tmp_path / f"{i} a.json").write_text(r.choice(["", " \n", "﻿"]) + json.dumps(values, indent=indent, ensure_ascii=False) + r.choice(["", "\n"]))
        want += values
    found = scan_json_texts(spark, str(tmp_path))
    rows = found.collect()
    assert found.rdd.getNumPartitions() > 10
    assert len({x.row_id for x in rows}) == len(rows)
    assert sorted(json.dumps(json.loads(x.value)) for x in rows) == sorted(map(json.dumps, want))


BROKEN = [
    '[{"a":1}', '[{"a":1}]]', '[{"a":1}] [1]', '[{"a":1},]', '[,{"a":1}]', '[{"a":1},,{"a":2}]', '[{"a":"1]', "[",
    '[{"a":1}],[8]', '[{"a":1}]x', '[{"a":1}]}', '{"a":1}]', '[[{"a":1}]',
]


@pytest.mark.parametrize("text", BROKEN)
def test_what_is_no_array_is_read_as_lines(spark, tmp_path, small_splits, text):
    padded = text.replace('{"a":1}', '{"a":1,"b":"' + "x" * 100 + '"}')
    (tmp_path / "x.json").write_text(padded + "\n\n{}")
    assert _texts(scan_json_texts(spark, str(tmp_path))) == sorted([padded, "{}"])


def test_a_broken_element_is_a_row_of_its_own(spark, tmp_path, small_splits):
    deep = '{"text":' + "[" * 2500 + "]" * 2500 + "}"
    elements = ['{"text":"one"}', deep, '{"text":"two"', '{"text":[1,]}', "nope", '{"text":"three"}', "5"]
    for name, join in (("lines", ",\n"), ("one", ",")):
        # the third would leave the array open
        (tmp_path / f"{name}.json").write_text("[" + join.join(e for i, e in enumerate(elements) if i != 2) + "]")
    data = load_text_corpus(spark, str(tmp_path), options=ReadOptions(json_documents=True))
    assert sorted(r.text for r in data.train.collect()) == ["one"] * 2 + ["three"] * 2
    found = sorted((r.error_code, r.value) for r in data.quarantine.collect())
    assert found == sorted(
        [("ROW_TOO_LARGE", deep), ("BAD_JSON", '{"text":[1,]}'), ("BAD_JSON", "nope"), ("NOT_A_MAPPING", "5")] * 2
    )
    values = scan_json(spark, str(tmp_path)).select(F.to_json("value").alias("v"), "line").collect()
    assert sorted(r.line for r in values if r.v is None) == sorted([deep, '{"text":[1,]}', "nope"] * 2)
    assert all((r.v is None) != (r.line is None) for r in values)


def test_an_element_beyond_a_variant_leaves_the_others(spark, tmp_path):
    big = '{"text":"' + "x" * (140 << 20) + '"}'
    (tmp_path / "big.json").write_text('[{"text":"a"},' + big + ',{"text":"b"}]')
    del big
    data = load_text_corpus(spark, str(tmp_path), options=ReadOptions(json_documents=True))
    assert sorted(r.text for r in data.train.collect()) == ["a", "b"]
    told = data.quarantine.select("error_code", F.length("value").alias("n")).collect()
    assert [tuple(r) for r in told] == [("ROW_TOO_LARGE", (140 << 20) + 11)]


def test_preference_rows_keep_the_error_of_their_line(spark, json_rows, tmp_path):
    deep = '{"prompt":"p","chosen":"a","rejected":' + "[" * 2500 + "]" * 2500 + "}"
    rows = to_preference_examples(json_rows(deep, "{", "[1]", {"prompt": "p"}, {"prompt": "p", "chosen": "a", "rejected": "b"}))
    got = [r.error.code if r.error else None for r in rows.orderBy("row_id").collect()]
    assert got == [codes.ROW_TOO_LARGE, codes.BAD_JSON, codes.NOT_A_MAPPING, codes.PREF_MISSING_FIELDS, None]
    (tmp_path / "p.jsonl").write_text(deep + '\n{"prompt":"p"}\n{"prompt":"p","chosen":"a","rejected":"b"}\n')
    data = load_dpo_dataset(spark, str(tmp_path / "p.jsonl"))
    assert sorted(r.error_code for r in data.quarantine.collect()) == [codes.PREF_MISSING_FIELDS, codes.ROW_TOO_LARGE]
    assert data.train.count() == 1
