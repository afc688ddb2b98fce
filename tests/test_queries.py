import os

import duckdb
import pytest

from pageloom import registry

#: A query over PDF files of all documents is slow on this data; the report_ queries and tests/test_pdf.py cover its parts.
SLOW = {"pdf_ingest"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - SLOW))
def test_query(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    if name in registry.ORACLE_SQL:
        want = duck.sql(registry.ORACLE_SQL[name])
        assert sorted(want.columns) == columns
        at = [want.columns.index(c) for c in columns]
        assert got == sorted(repr(tuple(r[k] for k in at)) for r in want.fetchall())


def test_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 200 and set(entry.oracle_sql()) <= set(entry.queries())
