import os

import duckdb
import pytest

from pageloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    want = con.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, sf).select(*want.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))
