import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliomart.operators.scd2 import scd2_history
from foliomart.operators.versions import VersionStore
from foliomart.sources.warehouse import Warehouse

KEY, TRACKED = T.StructField("k", T.LongType()), [T.StructField("name", T.StringType()), T.StructField("n", T.LongType())]
COLUMNS = ["k", "name", "n", "effective_date", "expiry_date", "is_current", "record_version"]
DAYS = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1), dt.date(2024, 4, 1)]
STATES = {
    DAYS[0]: [(1, "a", 1), (2, "x", None), (4, "q", 0)],
    DAYS[1]: [(1, "b", 1), (2, "x", None), (3, "c", 3)],
    DAYS[2]: [(1, "a", 1), (2, None, 5), (3, "c", 3)],
    DAYS[3]: [(1, "a", 1), (2, "x", None), (3, "d", 3)],
}
SCHEMA = "k long, name string, n long"


def rows(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    return VersionStore(Warehouse(spark, str(tmp_path / "w")), "dim/x", KEY, TRACKED, "x_key", buckets=8)


@pytest.mark.parametrize("order", [(3, 2, 1, 0), (2, 0, 3, 1)])
def test_any_order_gives_the_history(spark, store, order):
    keys = {}
    for i in order:
        store.merge(spark.createDataFrame(STATES[DAYS[i]], SCHEMA), DAYS[i])
        now = store.versions()
        found = {r["x_key"]: (r["k"], r["name"], r["n"]) for r in now.collect()}
        assert len(found) == now.count()
        # a surrogate key never changes its member or values, and none is lost
        assert all(found[k] == v for k, v in keys.items())
        keys = found
    snapshots = [(*row, day) for day, state in STATES.items() for row in state]
    df = spark.createDataFrame(snapshots, SCHEMA + ", day date")
    assert rows(store.versions()) == rows(scd2_history(df, "k", ["name", "n"], "day"))
    assert {r["is_current"] for r in store.current().collect()} == {"Y"} and store.current().count() == 4


def test_only_changed_buckets_are_written(spark, tmp_path):
    store = VersionStore(Warehouse(spark, str(tmp_path / "w")), "dim/x", KEY, TRACKED, "x_key", buckets=100)
    every = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("name"), F.lit(1).cast("long").alias("n"))
    assert store.merge(every, DAYS[0])["buckets"] == 100
    assert store.merge(every, DAYS[1]) == {"buckets": 0, "late": 0}
    before = {r[0] for r in store.current().select(F.input_file_name()).distinct().collect()}
    part = every.filter(store._bucket() == 17)
    assert 0 < part.count() < 30
    changed = every.unionByName(part).groupBy("k").agg(F.when(F.count("*") == 2, "b").otherwise("a").alias("name"), F.lit(1).cast("long").alias("n"))
    assert store.merge(changed, DAYS[2])["buckets"] == 1
    after = {r[0] for r in store.current().select(F.input_file_name()).distinct().collect()}
    assert len(before & after) == 99 and all("bucket=17/" in f for f in after - before)
    assert store.closed().count() == part.count()


def test_corrections_repeats_and_odd_rows(spark, store):
    store.merge(spark.createDataFrame([(1, "a", 1), (1, "b", 1), (None, "z", 1), (2, "x", 1)], SCHEMA), DAYS[1])
    store.merge(spark.createDataFrame([(1, "c", 1)], SCHEMA), DAYS[1])
    store.merge(spark.createDataFrame([(1, "c", 1)], SCHEMA), DAYS[1])
    store.merge(spark.createDataFrame([], SCHEMA), DAYS[2])
    store.merge(spark.createDataFrame([(2, "w", 1)], SCHEMA), DAYS[0])
    store.merge(spark.createDataFrame([(2, "v", 1)], SCHEMA), DAYS[0])
    assert rows(store.versions()) == [
        (1, "c", 1, DAYS[1], None, "Y", 1),
        (2, "v", 1, DAYS[0], dt.date(2024, 1, 31), "N", 1),
        (2, "x", 1, DAYS[1], None, "Y", 2),
    ]
