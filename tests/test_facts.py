import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from foliomart.operators import dimensions as d
from foliomart.operators import facts, keys, lookups
from foliomart.operators.calendar import calendar
from foliomart.operators.facts import build_fact_sales, load_summary, type_name_key
from foliomart.operators.lookups import Star
from foliomart.operators.quality import tag
from foliomart.schemas import source_schema
from foliomart.sources.staging import stage
from samples import META_HEADER, SALES_HEADER


def staged(spark, header, lines, source):
    rows = spark.createDataFrame([tuple(c or None for c in line) for line in lines], source_schema(source))
    return tag(stage(rows.toDF(*header.split(",")), source, F.lit("f")), source).checkpoint()


def sale(number, **given):
    cells = {
        "SaleNum": number, "DateStamp": "2024-05-01", "EdID": "E1", "Chnl": "CH001", "TQty": "10", "UPrice": "10.00",
        "Curr": "USD", "Dscnt": "0.1", "PD": "100", "BC": "100", "VScr": "5", "Typ": "Hardcover", **given,
    }
    return [cells[c] for c in SALES_HEADER.split(",")]


def meta(station, vendor, edition, author, title="T"):
    return [
        station, f"{station} DC", f"{station} land", "M1", "1 Lane, E3 8ZA", vendor, f"{vendor} Ltd", "8.2", "Paper",
        "A", "", "", edition, title, "Arts", "EN", author, author, "Ann", "Lee", "UK", "Poetry",
    ]


@pytest.fixture(scope="module")
def star(spark):
    rows = staged(spark, META_HEADER, [meta("DC001", "V1", "E1", "A1"), meta("DC002", "V2", "E2", "A2")], "raw_meta")
    day = F.lit(dt.date(2024, 1, 1))
    author, vendor = d.dim_author(rows, day).cache(), d.dim_vendor(rows, day).cache()
    tables = {
        "author": author, "vendor": vendor, "dc": d.dim_dc(rows, day),
        "product": d.dim_product(rows, author, vendor, day), "channel": d.dim_channel(spark),
        "product_type": d.dim_product_type(spark), "currency": d.dim_currency(spark),
    }
    named = {k: d.with_unknown(t, f"{k}_key").cache() for k, t in tables.items()}
    return Star(named, time=calendar(spark).cache(), station_vendor=d.station_vendor(rows).cache())


def test_dimensions(star):
    product = {r["edition_id"]: r for r in star["product"].collect()}
    author = {r["author_key"]: r["author_id"] for r in star["author"].collect()}
    vendor = {r["vendor_key"]: r["vendor_id"] for r in star["vendor"].collect()}
    assert author[product["E2"]["author_key"]] == "A2" and vendor[product["E2"]["vendor_key"]] == "V2"
    unknown = product["Unknown"]
    assert (unknown["product_key"], unknown["author_key"], unknown["is_current"]) == (-1, -1, "Y")
    assert {r["full_name"] for r in star["author"].collect()} == {"Ann Lee", "Unknown"}
    assert {r["postcode"] for r in star["dc"].collect()} == {"E3 8ZA", "Unknown"}
    seeds = {r["channel_code"]: (r["channel_key"], r["channel_type"]) for r in star["channel"].collect()}
    assert seeds["CH003"] == (1002, "Physical")


def test_rate_of_the_day_into_the_base_currency(spark, star):
    rates, refused = d.exchange_rates(
        spark.createDataFrame(
            [("USD", "GBP", "2024-05-01", "0.5", "B"), ("USD", "EUR", "2024-05-01", "9", "B"), ("EUR", "GBP", "2024-05-02", "3", "B")],
            ["from_code", "to_code", "rate_date", "exchange_rate", "rate_source"],
        ),
        star["currency"],
    )
    assert refused.count() == 0
    lines = [sale("S1"), sale("S2", DateStamp="2024-05-02"), sale("S3", Curr="EUR"), sale("S4", Curr="GBP")]
    fact, refused = build_fact_sales(staged(spark, SALES_HEADER, lines, "raw_sales"), star, 1, rates)
    got = {r["sale_number"]: r["unit_price_gbp"] for r in fact.collect()}
    assert got == {"S1": Decimal("5.00"), "S2": Decimal("7.90"), "S3": Decimal("8.50"), "S4": Decimal("10.00")}
    assert refused.count() == 0


def test_two_members_under_one_key_reject_the_row(spark, star):
    double = star["product"].filter("edition_id = 'E1'").withColumn("product_key", F.lit(5).cast("bigint"))
    both = Star({**star, "product": star["product"].unionByName(double)})
    lines = [sale("S1"), sale("S2", EdID="E2"), sale("S3", EdID="E2", Dscnt="")]
    fact, refused = build_fact_sales(staged(spark, SALES_HEADER, lines, "raw_sales"), both, 1)
    assert {r["sale_number"] for r in fact.collect()} == {"S2", "S3"}
    assert [(r["sale_num"], r["reject_reason"]) for r in refused.collect()] == [("S1", "AMBIGUOUS_PRODUCT")]
    assert dict(load_summary(fact, refused).collect()) == {"LOADED": 2, "AMBIGUOUS_PRODUCT": 1}
    # a missing discount stays missing and takes nothing off
    row = fact.filter("sale_number = 'S3'").first()
    assert row["discount_rate"] is None and row["net_amount_gbp"] == row["gross_amount_gbp"] == 79


def test_center_from_a_map(spark, star):
    centers = spark.createDataFrame([("E2", "DC002"), ("E1", "DC001")], "ed_id string, station_code string")
    lines = [sale("S1"), sale("S2", EdID="E2"), sale("S3", EdID="E9")]
    rows = staged(spark, SALES_HEADER, lines, "raw_sales")
    fact, _ = build_fact_sales(rows, star, 1, dc_map=centers)
    keys = {r["station_code"]: r["dc_key"] for r in star["dc"].collect()}
    got = {r["sale_number"]: r["dc_key"] for r in fact.collect()}
    assert got == {"S1": keys["DC001"], "S2": keys["DC002"], "S3": -1}
    first, _ = build_fact_sales(rows, star, 1)
    assert {r["dc_key"] for r in first.collect()} == {min(k for k in keys.values() if k > 0)}


def test_rows_are_accounted_for_and_reloads_add_nothing(spark, star):
    lines = [sale(f"S{i % 7}", TQty=str(i - 2), Dscnt="0.3" if i % 5 == 0 else "0.1") for i in range(40)]
    rows = staged(spark, SALES_HEADER, lines, "raw_sales")
    fact, refused = build_fact_sales(rows, star, 1)
    assert fact.count() + refused.count() == 40
    assert fact.filter("net_amount_gbp <> gross_amount_gbp - discount_amount_gbp").count() == 0
    again, refused = build_fact_sales(rows, star, 2, existing=fact)
    assert again.count() == 0 and refused.count() == 40


@pytest.mark.parametrize("most", [0, 1000])
def test_whole_rows_are_shuffled_once(spark, star, monkeypatch, most):
    """Duplicates are found on keys alone, by broadcast hashes or without; rows meet them where they are numbered."""
    monkeypatch.setattr(keys, "BROADCAST_HASHES", most)
    monkeypatch.setattr(facts, "PIECE_ROWS", 30)
    plans = {}
    real = keys.saved
    monkeypatch.setattr(keys, "saved", lambda df, path: (plans.update({path.split("/")[-1]: df}), real(df, path))[1])
    lines = [sale(f"S{i % 30}", DateStamp=f"2024-05-{1 + i * 7 % 28:02d}", TQty=str(1 + i)) for i in range(100)]
    rows = staged(spark, SALES_HEADER, lines, "raw_sales").checkpoint()
    rows = rows.unionByName(rows.filter("tqty = 1"))  # a row that was delivered twice, under one id
    held = spark.createDataFrame([("S7",), ("S99",)], "sale_number string")
    fact, refused = build_fact_sales(rows, star, 1, existing=held, first_key=50)
    best = {}
    for r in sorted(rows.collect(), key=lambda r: (r["date_parsed"], r["stg_sales_id"])):
        best.setdefault(r["sale_num"], (r["date_parsed"], r["stg_sales_id"]))
    first = sorted(v for k, v in best.items() if k != "S7")
    got = {int(r["source_record_id"]): r["sales_fact_key"] for r in fact.collect()}
    assert got == {number: 50 + i for i, (_, number) in enumerate(first)}
    assert sorted(r["stg_sales_id"] for r in refused.filter("reject_reason = 'DUPLICATE'").collect()) == sorted(
        r["stg_sales_id"] for r in rows.collect() if r["stg_sales_id"] not in got
    )
    assert fact.filter("gross_profit_gbp <> net_amount_gbp - total_cost_gbp").count() == 0
    plan = plans["kept"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan


def test_type_names_match_loosely(frame):
    df = frame("t string", ("e‑Book",), ("E-BOOK",), ("e-book",))
    assert {r[0] for r in df.select(type_name_key(F.col("t"))).collect()} == {"E-BOOK"}


def test_large_dimensions_are_not_broadcast(spark, star, monkeypatch):
    """Past the bound the lookup shuffles, and adaptive execution splits the hot key."""
    rows = spark.range(300000).select(
        F.when(F.col("id") % 3 == 0, "E1").otherwise(F.concat(F.lit("X"), F.col("id").cast("string"))).alias("ed_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("load"),
    )
    side = spark.range(50000).select(F.concat(F.lit("X"), F.col("id").cast("string")).alias("ed_id"), F.lit(1).alias("v"))
    side = side.unionByName(spark.createDataFrame([("E1", 2)], "ed_id string, v int"))
    small = lookups.attach(rows, side, ["ed_id"])
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 1000)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        # the path of the loads: a large product dimension, two thirds of the sales in one edition
        products = spark.range(1, 5000).select(
            *[F.col("id").alias(c) if c == "product_key" else F.concat(F.lit("P"), F.col("id").cast("string")).alias(c)
              if c == "edition_id" else F.lit("Y").alias(c) if c == "is_current"
              else F.lit(None).cast(star["product"].schema[c].dataType).alias(c) for c in star["product"].columns]
        )
        wide = Star({**star, "product": star["product"].unionByName(products).checkpoint()})
        one = staged(spark, SALES_HEADER, [sale("S1")], "raw_sales")
        row = one.first()
        changing = {
            "stg_sales_id": F.col("id"), "sale_num": F.concat(F.lit("S"), F.col("id").cast("string")),
            "ed_id": F.when(F.col("id") % 3 > 0, "E1").otherwise(F.concat(F.lit("P"), (F.col("id") % 5000).cast("string"))),
        }
        sales = spark.range(20000).select(
            *[changing.get(f.name, F.lit(row[f.name])).cast(f.dataType).alias(f.name) for f in one.schema.fields]
        ).checkpoint()
        plans = []
        real = facts.saved
        monkeypatch.setattr(facts, "saved", lambda df, path: (plans.append(df), real(df, path))[1])
        build_fact_sales(sales, wide, 1)
        tagged = next(p for p in plans if "reject_reason" in p.columns)
        tagged.collect()
        assert "skew=true" in tagged._jdf.queryExecution().executedPlan().toString()

        big = lookups.attach(rows, side, ["ed_id"])
        assert big.filter("v = 2").count() == 100000
        big.write.format("noop").mode("overwrite").save()
        assert big.collect() and "skew=true" in big._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
