"""Every registered batch query against its SQL on DuckDB, at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from tools.check_oracles import TABLES, rows_of
from wattspark.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
# streaming and sink queries have their own tests
BATCH = [n for n in ORACLES if not n.startswith(("k0", "k1", "s0", "st", "a01_k"))]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", BATCH)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    want = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of(want.columns, want.fetchall())


def test_entry_returns_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
