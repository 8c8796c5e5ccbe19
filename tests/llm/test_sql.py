"""Every llm query with SQL, against it."""

import duckdb
import pytest

from loomset.llm.oracles import ORACLES
from loomset.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    want = con.execute(f"select {', '.join(columns)} from ({ORACLES[name]})").fetchall()
    assert want and sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(want, key=repr)
