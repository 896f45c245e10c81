"""Every registered query against its SQL in DuckDB, over whole tables."""

import os

import pytest

import __spark_entry__ as entry
from entry_queries import QUERIES
from entry_sql import ORACLES
from tools.compare import rows_of

duckdb = pytest.importorskip("duckdb")
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    made = duckdb.connect()
    for table in TABLES:
        made.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return made


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 18


def test_every_text_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(columns, result.fetchall())
