"""Trade tables as warehouse sources: how rows are dealt to the part and edition lookups, what a stored fact leaves behind."""

import datetime as dt
import os

from pyspark.sql import functions as F

from foliomart.operators import lookups
from foliomart.session import saved
from foliomart.sources import trade


def tables(spark, folder):
    orders = [(k, dt.datetime(1997, 1, 1 + k % 28), "1-URGENT") for k in range(40)]
    lines = [(i % 40, 1 + i // 40, 1 + i % 7, 3, 5.0, 100.0 + i, 0.05, 0.01, "A", "O") for i in range(120)]
    parts = [(k, "BRASS", k, 9.5) for k in range(1, 7)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_size int, p_retailprice double").write.parquet(f"{folder}/part.parquet")


def test_rows_dealt_by_part_find_their_edition_without_another_shuffle(spark, tmp_path, monkeypatch):
    tables(spark, tmp_path)
    editions = spark.range(1, 7).select(F.col("id").cast("string").alias("ed_id"), F.col("id").alias("key"))
    few = trade.staged_sales(spark, str(tmp_path)).join(editions, "ed_id", "left")
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 0)
    found = trade.staged_sales(spark, str(tmp_path)).join(lookups.shuffled_if_large(editions), "ed_id", "left")
    plan = found._jdf.queryExecution().executedPlan().toString()
    # lines and orders by order, both and parts by part, editions; files are small, but nothing goes through the driver
    assert plan.count("Exchange hashpartitioning") == 5 and "BroadcastExchange" not in plan
    # a hot part may still be split
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    # parts are 1 to 6, lines name 1 to 7
    assert sorted(map(tuple, few.collect()), key=repr) == sorted(map(tuple, found.select(few.columns).collect()), key=repr)
    assert found.count() == sum(1 + i % 7 < 7 for i in range(120))
    assert {(r["ed_id"], r["key"]) for r in found.collect()} == {(str(k), k) for k in range(1, 7)}


def test_a_stored_fact_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    works = []

    def built(spark, sf, work):
        works.append(work)
        return saved(spark.range(5).select("id", F.lit(19970101).alias("time_key"), F.lit(1).alias("product_key")), f"{work}/kept"), None

    monkeypatch.setattr(trade, "sales", built)
    assert trade.stored_fact(spark, str(tmp_path), "fact_sales").count() == 5
    assert len(works) == 1 and not os.path.exists(works[0].removeprefix("file:"))
