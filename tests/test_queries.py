"""Every registered query against its SQL."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from verify.oracles import ORACLES
from verify.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("documents", "conversations", "benchmark", "labels")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(row) for row in df.select(*columns).collect())
    result = db.execute(ORACLES[name])
    assert sorted(c[0] for c in result.description) == columns
    want = db.execute(f"select {', '.join(columns)} from ({ORACLES[name]})").fetchall()
    assert len(want) > 0
    assert got == sorted(want)


def test_entry(spark):
    assert entry(spark).count() > 0
