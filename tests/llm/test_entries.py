"""Every registered query of the subpackage against its SQL in DuckDB, over whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from foliomart.llm.entries import QUERIES
from foliomart.llm.oracles import ORACLES
from tools.compare import rows_of

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"op6_neighbours", "op10_packing"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got
    if name in ORACLES:
        duck = duckdb.connect()
        for table in ("documents", "embeddings", "pages", "conversations", "benchmark"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        result = duck.execute(ORACLES[name])
        columns = [d[0] for d in result.description]
        assert got == rows_of(columns, result.fetchall())
