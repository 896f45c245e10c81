"""The registered queries: every operator over the trade tables of a folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliomart.functions import numeric as n
from foliomart.functions.dates import parse_dates
from foliomart.operators import calendar as cal
from foliomart.operators import dimensions as dims
from foliomart.operators import facts, keys, quality, scd2
from foliomart.operators.keyindex import KeyIndex
from foliomart.operators.lookups import attach, shuffled_if_large
from foliomart.operators.versions import VersionStore
from foliomart.plans import queries as bi
from foliomart.plans import pipeline, rollups, trends
from foliomart.schemas import FACT_DAILY, FACT_SALES, SOURCE_COLUMNS, STAGING_ID, staging_schema
from foliomart.session import release, saved, scratch_path, together
from foliomart.sources import extract, staging, trade
from foliomart.sources.warehouse import Warehouse, rewrite_months, total_count, write_fact
from foliomart.streaming import incremental

OPENING = dt.date(1998, 6, 30)
CLOSING = dt.date(2000, 12, 31)


def typed(df: DataFrame, **names: str) -> DataFrame:
    """Decimals as doubles, so the figures compare across engines."""
    return df.select(
        *[
            (F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else F.col(f.name)).alias(
                names.get(f.name, f.name)
            )
            for f in df.schema.fields
        ]
    )


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _sales(spark, sf):
    return trade.stored_fact(spark, sf, "fact_sales")


def _daily(spark, sf):
    return trade.stored_fact(spark, sf, "fact_daily")


# --- calendar


def calendar_dim(spark: SparkSession, sf: str) -> DataFrame:
    return cal.calendar_spanning(trade.table(spark, sf, "orders"), "o_orderdate")


def calendar_report(spark: SparkSession, sf: str) -> DataFrame:
    return cal.calendar_report(calendar_dim(spark, sf))


def calendar_easter(spark: SparkSession, sf: str) -> DataFrame:
    year = F.year("o_orderdate")
    years = trade.table(spark, sf, "orders").groupBy(year.alias("year")).agg(F.count(F.lit(1)).alias("n_orders"))
    return years.select("year", cal.easter_sunday(F.col("year")).alias("easter_sunday"), "n_orders")


# --- extract, dates, staging


def _written_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates as texts in three formats, one unreadable, one missing."""
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(day, "yyyy-MM-dd"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(day, "dd-MM-yyyy"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit(" "), F.date_format(day, "yyyy/M/d")))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format(day, "yyyy.MM.dd"))
    )
    return trade.table(spark, sf, "orders").select("o_orderkey", text.alias("date_stamp"))


def parse_dates_multi_format(spark: SparkSession, sf: str) -> DataFrame:
    return parse_dates(_written_dates(spark, sf), "date_stamp").select("o_orderkey", "date_parsed", "date_format")


def staging_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Line items written as a sales extract, read back, staged, judged and totalled by month."""
    staged = trade.staged_sales(spark, sf)
    names = {"SaleNum": "sale_num", "DateStamp": "date_stamp", "EdID": "ed_id", "Chnl": "chnl",
             "TQty": "tqty", "UPrice": "uprice", "Curr": "curr", "Dscnt": "dscnt", "PD": "pd",
             "BC": "bc", "VScr": "vscr", "Typ": "typ"}
    path = scratch_path(spark, "extract")
    staged.select(*[F.col(c).cast("string").alias(h) for h, c in names.items()]).write.option("header", True).csv(path)
    rows, _ = extract.extract(spark, path, "raw_sales")
    read = quality.tag(staging.stage(rows, "raw_sales"), "raw_sales")
    month = F.date_format("date_parsed", "yyyy-MM")
    made = read.groupBy(month.alias("month"), "validation_status", "processed_flag").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("tqty").cast("double").alias("quantity"),
        F.sum("uprice").cast("double").alias("price"),
        F.count("dscnt").alias("discounted"),
    )
    return made


def extract_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and columns of two extracts written from the tables."""
    paths = {}
    for source, name in (("raw_sales", "lineitem"), ("raw_daily", "orders")):
        paths[source] = scratch_path(spark, source)
        trade.table(spark, sf, name).write.option("header", True).csv(paths[source])
    extracts = extract.extract_all(spark, paths, rules={})
    metas = [meta for _, meta in extracts.values()]
    files = metas[0].unionByName(metas[1])
    return files.groupBy("source").agg(
        F.sum("total_rows").alias("total_rows"), F.max(F.size("columns")).alias("n_columns")
    )


def archive_split(spark: SparkSession, sf: str) -> DataFrame:
    """Processed rows not archived yet (those before 1998 are), and rows that stay in staging."""
    flagged = staging.mark_processed(trade.staged_sales(spark, sf), _sales(spark, sf), "raw_sales")
    archived = flagged.filter((F.col("processed_flag") == "Y") & (F.year("date_parsed") < 1998))
    fresh, remaining = staging.archive(flagged, archived, "raw_sales")
    parts = fresh.select(F.lit("ARCHIVE").alias("part"), "date_parsed", "tqty").unionByName(
        remaining.select(F.lit("STAGING").alias("part"), "date_parsed", "tqty")
    )
    return parts.groupBy("part", F.year("date_parsed").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("tqty").cast("double").alias("quantity")
    )


def unprocessed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Staged rows a second load would still find: the duplicates."""
    todo = staging.unprocessed(trade.staged_sales(spark, sf), _sales(spark, sf), "raw_sales")
    return todo.select("stg_sales_id", "sale_num")


def archived_total(spark: SparkSession, sf: str) -> DataFrame:
    """Processed rows of both staging tables together."""
    flagged = [
        staging.mark_processed(trade.staged_sales(spark, sf), _sales(spark, sf), "raw_sales"),
        staging.mark_processed(trade.staged_daily(spark, sf), _daily(spark, sf), "raw_daily"),
    ]
    return total_count(flagged, "processed_flag = 'Y'")


# --- quality


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as an extract would deliver them, with some cells empty."""
    return trade.table(spark, sf, "lineitem").select(
        F.when(F.col("l_discount") > 0, F.col("l_discount").cast("decimal(5,2)").cast("string")).alias("Dscnt"),
        F.col("l_quantity").cast("int").cast("string").alias("TQty"),
        (F.col("l_extendedprice") - 5000).cast("decimal(12,2)").cast("string").alias("Margin"),
        F.col("l_returnflag").alias("Flag"),
        F.when(F.col("l_linestatus") == "O", F.date_format("l_shipdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("l_shipdate", "yyyy.MM.dd")).alias("DateStamp"),
    )


def quality_findings(spark: SparkSession, sf: str) -> DataFrame:
    rules = quality.Rules(
        numeric=["Dscnt", "TQty", "Absent"],
        positive=["Margin"],
        ranges={"Dscnt": (0.02, 0.08), "TQty": (1, 45)},
        categories={"Flag": ["A", "N"]},
        dates=["DateStamp"],
    )
    found = quality.check(_texts(spark, sf), "raw_sales", {"raw_sales": rules})
    return found.select(
        "source_table", "validation_rule", "severity", "total_records", "valid_records",
        "invalid_records", "error_details",
    )


def row_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """Verdicts where a discount is mandatory and dates before 1996 do not parse."""
    staged = trade.staged_sales(spark, sf)
    staged = staged.withColumn("date_parsed", F.when(F.year("date_parsed") >= 1996, F.col("date_parsed")))
    rules = {"raw_sales": quality.Rules(dates=["date_stamp"], mandatory=["sale_num", "dscnt"])}
    tagged = quality.tag(staged, "raw_sales", rules)
    return tagged.groupBy("validation_status", "validation_errors").agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicates(trade.staged_sales(spark, sf), ["sale_num"])


def orphan_keys(spark: SparkSession, sf: str) -> DataFrame:
    lines = trade.table(spark, sf, "lineitem")
    catalogue = trade.stored_star(spark, sf)["product"]
    return quality.orphans(lines, catalogue, "l_partkey", "product_key")


def constraint_violations(spark: SparkSession, sf: str) -> DataFrame:
    checks = {
        **quality.SALES_CHECKS,
        **quality.not_null_checks(["discount_rate", "net_amount_gbp"]),
        "ck_quantity_small": "quantity_sold <= 40",
        "ck_discount_small": "discount_rate < 0.05",
    }
    return quality.violations(_sales(spark, sf), checks)


def daily_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Staged days that would break each declared constraint of the daily fact."""
    staged = trade.staged_daily(spark, sf)
    named = staged.select(
        F.col("pd").alias("print_run_qty"), F.col("us").alias("units_sold"), F.col("rev").alias("revenue_gbp"),
        (F.col("tmp") * 5).alias("temperature_celsius"), (F.col("hmd") * 2).alias("humidity_pct"),
        (F.col("vscr") + 1).alias("vendor_score"),
    )
    return quality.violations(named, quality.DAILY_CHECKS)


def dimension_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Members that break each declared constraint of the dimensions."""
    meta = trade.meta_rows(spark, sf)
    # raw scores, before they are made to fit
    scored = meta.filter(F.col("vendor_id").isNotNull()).select("vendor_id", "vendor_score").distinct()
    star = trade.stored_star(spark, sf)
    parts = [
        ("vendor", scored.withColumn("is_current", F.lit("Y")), quality.VENDOR_CHECKS),
        ("product", star["product"].withColumn("is_current", F.when(F.col("author_key") < 20, "Y").otherwise("?")), quality.VERSION_CHECKS),
        ("product_type", star["product_type"], quality.TYPE_CHECKS),
        ("currency", star["currency"], quality.CURRENCY_CHECKS),
        ("time", star["time"].withColumn("month_number", F.col("month_number") + 1), quality.TIME_CHECKS),
    ]
    made = [quality.violations(df, checks).select(F.lit(name).alias("dimension"), "*") for name, df, checks in parts]
    return reduce(DataFrame.unionByName, made)


def discount_imputed(spark: SparkSession, sf: str) -> DataFrame:
    filled = quality.impute_discount(trade.staged_sales(spark, sf), "channel_mean")
    return typed(filled.filter(F.col("dscnt").isNull()).select("stg_sales_id", "chnl", "discount_imputed"))


# --- keys, history, dimensions


def first_valid_sales(spark: SparkSession, sf: str) -> DataFrame:
    kept, _ = keys.first_valid(trade.staged_sales(spark, sf), ["sale_num"], ["date_parsed", "stg_sales_id"])
    return kept.select("sale_num", "stg_sales_id")


def first_valid_existing(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome per row when the sales of 1995 are in the fact already."""
    staged = trade.staged_sales(spark, sf).select("sale_num", "date_parsed", "stg_sales_id")
    existing = staged.filter(F.year("date_parsed") == 1995).select("sale_num")
    kept, rest = keys.first_valid(staged, ["sale_num"], ["date_parsed", "stg_sales_id"], existing)
    both = kept.withColumn("outcome", F.lit("KEPT")).unionByName(rest.withColumn("outcome", F.lit("DUPLICATE")))
    return both.groupBy("outcome", F.year("date_parsed").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))


def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    orders = trade.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return keys.assign_keys(orders, "day", "o_orderkey", "order_key", 100000)


def fact_key_density(spark: SparkSession, sf: str) -> DataFrame:
    """Fact keys run from 100000 without gaps."""
    key = F.col("sales_fact_key")
    return _sales(spark, sf).agg(
        F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count_distinct(key).alias("n_keys")
    )


def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    orders = trade.table(spark, sf, "orders")
    return scd2.scd2_history(orders, "o_custkey", ["o_orderstatus"], "o_orderdate", ["o_orderkey"])


def _status_at(spark: SparkSession, sf: str, day: dt.date) -> DataFrame:
    """Each customer's latest order status on a day."""
    orders = trade.table(spark, sf, "orders").filter(F.col("o_orderdate").cast("date") <= F.lit(day))
    latest = F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey"))
    return orders.groupBy("o_custkey").agg(latest.alias("o_orderstatus"))


def scd2_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Versions after the state of one day is followed by that of a later day."""
    schema = T.StructType.fromDDL(
        "customer_key bigint, o_custkey bigint, o_orderstatus string, effective_date date,"
        " expiry_date date, is_current string, record_version int"
    )
    nothing = spark.createDataFrame([], schema)
    merged = nothing
    for day in (OPENING, CLOSING):
        state = _status_at(spark, sf, day)
        merged = scd2.scd2_merge(
            merged, state, "o_custkey", ["o_orderstatus"], F.lit(day), "customer_key", 1000
        )
    return merged


def scd2_late(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' order status by two years, delivered out of order: every second extract first, then the others backwards."""
    even = F.year(F.col("o_orderdate").cast("date"))
    orders = trade.table(spark, sf, "orders").withColumn("year", even + F.pmod(even, F.lit(2)))
    latest = F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("o_orderstatus")
    states = saved(orders.groupBy("year", "o_custkey").agg(latest), scratch_path(spark, "states"))
    years = sorted(r[0] for r in states.select("year").distinct().collect())
    store = VersionStore(
        Warehouse(spark, scratch_path(spark, "versions")), "dim/customer", states.schema["o_custkey"], [states.schema["o_orderstatus"]], "customer_key",
        buckets=16,
    )
    for year in [*years[1::2], *reversed(years[::2])]:
        store.merge(states.filter(F.col("year") == year).drop("year"), dt.date(year, 12, 31))
    return store.versions().drop("customer_key")


def _dimension(spark: SparkSession, sf: str, build: Callable, *drop: str) -> DataFrame:
    made = build(trade.meta_rows(spark, sf), F.lit(OPENING))
    return typed(made.drop("created_date", "created_by", "modified_date", "modified_by", *drop))


def dim_author(spark: SparkSession, sf: str) -> DataFrame:
    return _dimension(spark, sf, dims.dim_author, "author_key")


def dim_vendor(spark: SparkSession, sf: str) -> DataFrame:
    return _dimension(
        spark, sf, dims.dim_vendor, "vendor_key", "avg_delivery_days", "on_time_percentage", "cost_variance_pct"
    )


def dim_dc(spark: SparkSession, sf: str) -> DataFrame:
    return _dimension(spark, sf, dims.dim_dc, "dc_key", "region_code", "region_name")


def dim_product(spark: SparkSession, sf: str) -> DataFrame:
    """Editions with the natural keys their author and vendor keys lead back to."""
    meta = trade.meta_rows(spark, sf)
    author, vendor = dims.dim_author(meta, F.lit(OPENING)), dims.dim_vendor(meta, F.lit(OPENING))
    product = dims.dim_product(meta, author, vendor, F.lit(OPENING))
    return (
        product.join(author.select("author_key", "author_id"), "author_key")
        .join(vendor.select("vendor_key", "vendor_id"), "vendor_key", "left")
        .select("edition_id", "product_title", "product_category", "product_language", "author_id", "vendor_id",
                "effective_date", "is_current", "record_version")
    )


def station_vendor(spark: SparkSession, sf: str) -> DataFrame:
    return dims.station_vendor(trade.meta_rows(spark, sf))


# --- facts

_AUDIT = ["source_system", "load_date", "load_batch_id", "created_date", "created_by"]


def fact_sales(spark: SparkSession, sf: str) -> DataFrame:
    return typed(_sales(spark, sf).drop("sales_fact_key", "year_month", *_AUDIT))


def fact_sales_rejected(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = trade.sales(spark, sf, unknown="reject")
    return rejected.select("stg_sales_id", "sale_num", "reject_reason")


def fact_daily(spark: SparkSession, sf: str) -> DataFrame:
    return typed(_daily(spark, sf).drop("daily_ops_fact_key", "notes", "year_month", *_AUDIT))


def fact_daily_rejected(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = trade.daily(spark, sf)
    return rejected.select("stg_daily_id", "reject_reason")


def fact_sales_first_center(spark: SparkSession, sf: str) -> DataFrame:
    """Sales by center when nothing names the center of a sale: all go to the first one."""
    staged = trade.staged_sales(spark, sf)
    fact, _ = facts.build_fact_sales(staged, trade.stored_star(spark, sf), batch_id=1)
    return fact.groupBy("dc_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("net_amount_gbp").cast("double").alias("net")
    )


def seed_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Sales by the delivered code tables: channels by priority, product types by return flag."""
    lines = trade.table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    orders = trade.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    code = F.concat(F.lit("CH00"), F.substring("o_orderpriority", 1, 1))
    kind = F.when(F.col("l_returnflag") == "A", "HRD").when(F.col("l_returnflag") == "R", "PBK").otherwise("EBK")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        code.alias("channel_code"), kind.alias("product_type_code")
    ).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").cast("decimal(18,2)").cast("double").alias("quantity"))
    channel = dims.dim_channel(spark).select("channel_key", "channel_code", "channel_name", "channel_type")
    kinds = dims.dim_product_type(spark).select("product_type_key", "product_type_code", "product_type_name", "is_physical")
    return sold.join(channel, "channel_code", "left").join(kinds, "product_type_code", "left")


def load_summary(spark: SparkSession, sf: str) -> DataFrame:
    fact, rejected = trade.sales(spark, sf, unknown="reject")
    return facts.load_summary(fact, rejected)


def exchange_rate_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Dated rates on working days, defaults otherwise, totalled by currency and month."""
    star = trade.stored_star(spark, sf)
    staged = trade.staged_sales(spark, sf)
    codes = star["currency"].select(F.col("currency_code").alias("curr"), "currency_key")
    days = star["time"].select(F.col("full_date").alias("date_parsed"), "time_key", "is_weekend")
    keyed = attach(attach(staged, codes, ["curr"], "inner"), days, ["date_parsed"], "inner")
    rate = n.ratio(F.sum("tqty"), F.sum("tqty") + F.count(F.lit(1))).cast("decimal(38,10)").cast(n.RATE)
    # the base currency, and a rate into it, by day; one more row into a currency that is not base
    rates = keyed.filter((F.col("curr") != "GBP") & (F.col("is_weekend") == "N")).groupBy(
        F.col("currency_key").alias("from_currency_key"), "time_key"
    ).agg(rate.alias("exchange_rate"))
    base = star["currency"].filter(F.col("is_base_currency") == "Y").agg(F.min("currency_key"))
    rates = rates.withColumn("to_currency_key", base.scalar())
    wrong = rates.withColumns({"to_currency_key": F.col("from_currency_key"), "exchange_rate": F.lit(0).cast(n.RATE)})
    priced = facts.exchange_rate(keyed, star, rates.unionByName(wrong))
    return priced.groupBy("curr", F.date_format("date_parsed", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("exchange_rate").cast("double").alias("sum_rate"),
        F.sum(n.fit(F.col("uprice") * F.col("exchange_rate"), n.MONEY)).cast("double").alias("sum_price_gbp"),
    )


def fact_sink_months(spark: SparkSession, sf: str) -> DataFrame:
    """A fact written by month, one year of it rewritten, then read by partition."""
    fact = _sales(spark, sf).drop("year_month")
    path = scratch_path(spark, "sink")
    write_fact(fact, path)
    rewrite_months(
        fact.filter(F.col("time_key").between(19990101, 19991231) & (F.col("quantity_sold") > 25)), path
    )
    return spark.read.parquet(path).groupBy("year_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("net_amount_gbp").cast("double").alias("net")
    )


# --- rollups and questions


def _rollup(name: str) -> Callable[[SparkSession, str], DataFrame]:
    table, build = rollups.ROLLUPS[name]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return typed(build(trade.stored_fact(spark, sf, table), trade.stored_star(spark, sf)))

    return run


def m4_vendor_cost_analysis(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_rollup("vendor_cost_analysis")(spark, sf), "cost_stddev", "cost_variance_pct")


def rollup_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The channel rollup stored, replaced and read back."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    made = rollups.channel_performance(_sales(spark, sf), trade.stored_star(spark, sf))
    rollups.refresh(warehouse, "channel_performance", made.limit(0))
    return typed(rollups.refresh(warehouse, "channel_performance", made))


def rollup_refresh_months(spark: SparkSession, sf: str) -> DataFrame:
    """A stored rollup that lacks most of 1999, after that year alone was computed anew."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    fact, star = _sales(spark, sf), trade.stored_star(spark, sf)
    partial = fact.filter((F.floor(F.col("time_key") / 10000) != 1999) | (F.col("quantity_sold") > 45))
    rollups.refresh(warehouse, "channel_performance", rollups.channel_performance(partial, star))
    made = rollups.refresh_touched(
        warehouse, "channel_performance", fact, lambda part: rollups.channel_performance(part, star), [1999]
    )
    return typed(made)


def _delta(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """The rollup from states of three batches, the fact is never read as a whole."""
    table, _ = rollups.ROLLUPS[name]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        warehouse, dims = Warehouse(spark, scratch_path(spark, "warehouse")), trade.stored_star(spark, sf)
        fact, states = trade.stored_fact(spark, sf, table), rollups.RollupStates(warehouse, name)
        batch = F.pmod(F.xxhash64("source_record_id"), F.lit(3)) + 1
        for number in (1, 2, 3):
            states.add(number, fact.filter(batch == number), dims)
        return rollups.refresh_from_states(warehouse, name, states.read([1, 2, 3]), dims)

    return run


def m6_delta_vendor_cost(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(typed(_delta("vendor_cost_analysis")(spark, sf)), "cost_stddev", "cost_variance_pct")


def _question(build: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return typed(build(_sales(spark, sf), trade.stored_star(spark, sf), trade.AS_OF))

    return run


def q7_formatted_report(spark: SparkSession, sf: str) -> DataFrame:
    result = bi.monthly_trend(_sales(spark, sf), trade.stored_star(spark, sf), trade.AS_OF)
    return bi.report("monthly_trend", result)


def q7_formatted_channels(spark: SparkSession, sf: str) -> DataFrame:
    result = bi.channel_efficiency(_sales(spark, sf), trade.stored_star(spark, sf), trade.AS_OF)
    return typed(bi.report("channel_efficiency", result))


# --- statistics


def correlations(spark: SparkSession, sf: str) -> DataFrame:
    pairs = [("discount_rate", "gross_margin_pct"), ("quantity_sold", "net_amount_gbp")]
    return rounded(trends.correlations(_sales(spark, sf), "channel_key", pairs), "correlation")


def outliers(spark: SparkSession, sf: str) -> DataFrame:
    found = trends.outliers(_sales(spark, sf), "product_type_key", "net_amount_gbp", limit=2.0)
    return rounded(typed(found.select("sale_number", "product_type_key", "net_amount_gbp", "score")), "score", digits=4)


def outliers_iqr(spark: SparkSession, sf: str) -> DataFrame:
    found = trends.outliers(_sales(spark, sf), "product_type_key", "gross_margin_pct", "iqr", 1.5)
    return typed(found.select("sale_number", "product_type_key", "gross_margin_pct", "score"))


def trend_forecast(spark: SparkSession, sf: str) -> DataFrame:
    made = trends.trend_forecast(_sales(spark, sf), trade.stored_star(spark, sf))
    return rounded(made, "slope", "forecast", digits=2)


def dc_percentile(spark: SparkSession, sf: str) -> DataFrame:
    return typed(trends.dc_percentile(_sales(spark, sf), trade.stored_star(spark, sf), trade.AS_OF))


def vendor_trend(spark: SparkSession, sf: str) -> DataFrame:
    return trends.vendor_trend(_daily(spark, sf), trade.stored_star(spark, sf))


def author_features(spark: SparkSession, sf: str) -> DataFrame:
    return trends.author_features(_sales(spark, sf), trade.stored_star(spark, sf))


def kmeans_segments(spark: SparkSession, sf: str) -> DataFrame:
    return trends.segments(trends.author_features(_sales(spark, sf), trade.stored_star(spark, sf)))


# --- loads

_loaded: dict[tuple[str, str], Warehouse] = {}
CUT = dt.date(1998, 7, 1)


# the names of product types that part types are delivered under; the other part types are no product type
DELIVERED_TYPES = {"STANDARD": "Hardcover", "SMALL": "Paperback", "MEDIUM": "e‑Book"}


def _written(df: DataFrame, columns: dict[str, str], path: str) -> None:
    """A delivery: one file per partition in the source's folder."""
    df.select(*[F.col(c).cast("string").alias(h) for h, c in columns.items()]).write.mode("append").option(
        "header", True
    ).option("escape", '"').csv(path)


def _warehouse(spark: SparkSession, sf: str) -> Warehouse:
    """A warehouse loaded in two deliveries, written once per application.

    Sales and daily rows up to a day and parts up to size 25 come first, by a full load. The rest then
    arrives in the same folders and is loaded incrementally, twice; the second time brings nothing
    new. A station stands for a supplier.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _loaded:
        root, folder = scratch_path(spark, "loaded"), scratch_path(spark, "deliveries")
        code = F.concat(F.lit("CH00"), F.substring("chnl", 1, 1))
        sold = trade.staged_sales(spark, sf).withColumn("chnl", code)
        kind = F.col("typ")
        for part_type, name in DELIVERED_TYPES.items():
            kind = F.when(F.col("typ") == part_type, name).otherwise(kind)
        moved = trade.staged_daily(spark, sf, by_supplier=True).withColumn("typ", kind)
        sizes = trade.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("publication_ed"), "p_size")
        meta = trade.meta_rows(spark, sf).withColumn("station_id", F.col("vendor_id")).join(shuffled_if_large(sizes), "publication_ed")
        folders = {name: f"{folder}/{name}" for name in ("raw_meta", "raw_sales", "raw_daily")}

        def deliver(early: bool) -> None:
            first = F.col("date_parsed") < F.lit(CUT)
            small = F.col("p_size") <= 25
            parts = (("raw_sales", sold, first), ("raw_daily", moved, first), ("raw_meta", meta, small))
            together(*[
                partial(_written, rows.filter(part if early else ~part), SOURCE_COLUMNS[source], folders[source])
                for source, rows, part in parts
            ])
            release(spark)

        options = {"effective": dt.date(1995, 1, 1), "days": (trade.FIRST_DAY, trade.LAST_DAY)}
        deliver(True)
        pipeline.run(spark, root, folders, **options)
        deliver(False)
        for _ in range(2):
            _loaded[key] = pipeline.run_incremental(spark, root, folders, scratch_path(spark, "state"), **options)
    return _loaded[key]


def incremental_daily(spark: SparkSession, sf: str) -> DataFrame:
    """The daily fact by month after both deliveries, and the rejects still open by reason."""
    warehouse = _warehouse(spark, sf)
    fact = warehouse.read("fact_daily", FACT_DAILY)
    loaded = fact.groupBy(F.floor(F.col("time_key") / 100).cast("int").alias("year_month")).agg(
        F.lit("LOADED").alias("outcome"), F.count(F.lit(1)).alias("n_rows"),
        F.sum("revenue_gbp").cast("double").alias("revenue"), F.sum("net_units").cast("double").alias("units"),
    )
    refused = pipeline.open_rejects(warehouse, "raw_daily").groupBy(F.col("reject_reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    nothing = F.lit(None).cast("double")
    return loaded.unionByName(
        refused.select(F.lit(None).cast("int").alias("year_month"), "outcome", "n_rows", nothing.alias("revenue"), nothing.alias("units"))
    )


def key_index(spark: SparkSession, sf: str) -> DataFrame:
    """Which sale numbers an index of the early shipments holds, by month; the index grows by portions and is laid down anew."""
    lines = trade.table(spark, sf, "lineitem")
    day, number = F.col("l_shipdate").cast("date"), F.concat_ws("-", "l_orderkey", "l_linenumber")
    lines = lines.select(number.alias("sale_number"), day.alias("day"), "l_returnflag")
    early = lines.filter(F.col("day") < F.lit(CUT))
    index = KeyIndex(Warehouse(spark, scratch_path(spark, "indexed")), "sale_number", capacity=10_000)
    for flag in ("A", "N", "R"):
        index.add(early.filter(F.col("l_returnflag") == flag).select("sale_number"))
    known = index.known(lines.select("sale_number")).select(F.col("key").alias("sale_number"), F.lit(True).alias("known"))
    return lines.join(known, "sale_number", "left").groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(
        F.count_if("known").alias("n_known"), F.count_if(F.col("known").isNull()).alias("n_new")
    )


def archived_load(spark: SparkSession, sf: str) -> DataFrame:
    """Staged rows by source and outcome after both deliveries: archived with their flag, or still staged without."""
    warehouse = _warehouse(spark, sf)
    pipeline.archive_processed(spark, warehouse.root)
    made = []
    for source in ("raw_sales", "raw_daily"):
        key = STAGING_ID[source]
        archived = warehouse.read(f"archive/{source}", staging_schema(source)).select(key, "processed_flag")
        staged = pipeline.staged_table(warehouse, source).select(key, F.col("validation_status").alias("status"))
        made.append(
            staged.join(archived, key, "left").groupBy(F.lit(source).alias("source"), "status", F.coalesce("processed_flag", F.lit("N")).alias("flag"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_ids"))
        )
    return reduce(DataFrame.unionByName, made)


def incremental_load(spark: SparkSession, sf: str) -> DataFrame:
    """The sales fact after both deliveries: sales of editions unknown when they came keep -1."""
    fact = _warehouse(spark, sf).read("fact_sales", FACT_SALES)
    return fact.groupBy(F.floor(F.col("time_key") / 100).cast("int").alias("year_month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("sale_number").alias("n_sales"),
        F.sum("net_amount_gbp").cast("double").alias("net"), F.count_if(F.col("product_key") == -1).alias("unknown_editions"),
    )


def exchange_rates_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as dated exchange rates in two loads of the same days: rates stored by currency and year, and refused rows by reason."""
    w = Warehouse(spark, scratch_path(spark, "rates"))
    w.replace("dim/currency", dims.dim_currency(spark))
    priority = F.substring("o_orderpriority", 1, 1)
    code = F.when(priority == "1", "USD").when(priority == "2", "EUR").when(priority == "3", "GBP").otherwise("XXX")
    given = trade.table(spark, sf, "orders").select(
        code.alias("from_code"),
        F.lit("GBP").alias("to_code"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date").cast("string")).alias("rate_date"),
        # some are not positive, some do not fit
        ((F.col("o_totalprice").cast(n.MONEY) - 30000) * 3).alias("exchange_rate"),
        F.col("o_orderstatus").alias("rate_source"),
        F.pmod("o_orderkey", F.lit(2)).alias("turn"),
    )
    for turn in (0, 1):
        load = pipeline.Load(w, "LOAD_RATES")
        load.run(lambda: pipeline.load_rates(load, given.filter(F.col("turn") == turn).drop("turn")))
    codes = w.current("dim/currency").select("currency_code", F.col("currency_key").alias("from_currency_key"))
    stored = w.current("dim/exchange_rate").join(codes, "from_currency_key").groupBy(
        F.lit("STORED").alias("outcome"), F.col("currency_code").alias("from_code"), F.floor(F.col("time_key") / 10000).cast("int").alias("year")
    )
    refused = w.read("rejected/exchange_rate").groupBy(
        F.col("reject_reason").alias("outcome"), "from_code", F.year(F.col("rate_date").cast("date")).alias("year")
    )
    figures = [F.count(F.lit(1)).alias("n_rows"), F.sum("exchange_rate").cast("double").alias("total")]
    return stored.agg(*figures).unionByName(refused.agg(*figures))


def staging_emptied(spark: SparkSession, sf: str) -> DataFrame:
    """Sales staged after staging was emptied, by month: ids go on after those that were emptied, the log says what was done."""
    w, folder = Warehouse(spark, scratch_path(spark, "emptied")), scratch_path(spark, "emptied-in")
    sold, first = trade.staged_sales(spark, sf), F.col("date_parsed") < F.lit(CUT)
    tops = []
    for number, rows in enumerate((sold.filter(first), sold.filter(~first))):
        _written(rows, SOURCE_COLUMNS["raw_sales"], f"{folder}/{number}")
        load = pipeline.Load(w, "STAGE")
        load.run(lambda: pipeline.stage_rows(load, "raw_sales", extract.extract(spark, f"{folder}/{number}", "raw_sales")[0]))
        tops.append(load.book.top("raw_sales"))
        if number == 0:
            pipeline.truncate_staging(spark, w.root)
    emptied = w.batches().filter(F.col("batch_name") == "TRUNCATE_STAGING").agg(F.max("status")).scalar()
    key = STAGING_ID["raw_sales"]
    return pipeline.staged_table(w, "raw_sales").groupBy(F.date_format("date_parsed", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_ids"),
        F.bool_and(F.col(key) > tops[0]).alias("ids_go_on"), F.first(emptied).alias("emptied"),
    )


def audit_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Who made and changed versions of customers: every version names its maker, a closed one who closed it."""
    schema = T.StructType.fromDDL(
        "customer_key bigint, o_custkey bigint, o_orderstatus string, effective_date date, expiry_date date, is_current string,"
        " record_version int, created_date timestamp, created_by string, modified_date timestamp, modified_by string"
    )
    merged = spark.createDataFrame([], schema)
    for day in (OPENING, CLOSING):
        merged = scd2.scd2_merge(merged, _status_at(spark, sf, day), "o_custkey", ["o_orderstatus"], F.lit(day), "customer_key", 1000)
    made = (F.col("created_by") == F.current_user()) & F.col("created_date").isNotNull()
    changed = (F.col("modified_by") == F.current_user()) & (F.col("modified_date") >= F.col("created_date"))
    return merged.groupBy("is_current", "record_version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(made).alias("n_made"), F.count_if(changed).alias("n_changed")
    )


def load_log(spark: SparkSession, sf: str) -> DataFrame:
    """What the logs say about the three loads: batches, and the rows their steps handled."""
    warehouse = _warehouse(spark, sf)
    loads = warehouse.batches().filter(F.col("batch_name").isin("FULL_LOAD", "INCREMENTAL_LOAD"))
    batches = loads.select("batch_id", "batch_name", F.lit("-").alias("step"), "status", "records_processed")
    steps = warehouse.steps().join(loads.select("batch_id", "batch_name"), "batch_id").select(
        "batch_id", "batch_name", F.regexp_replace("step_name", " [0-9]+$", "").alias("step"), "status", "records_processed"
    )
    return batches.unionByName(steps.filter("step <> 'rollups'"))


# --- streams


def _events(spark: SparkSession, sf: str) -> DataFrame:
    schema = trade.table(spark, sf, "events").schema
    found = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return found.withColumn("ts", F.col("ts").cast("timestamp"))


def stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Days of the event stream, those still open at its end included."""
    totals = incremental.stream_daily(
        _events(spark, sf).withColumn("value", F.col("value").cast(n.MONEY)), "ts", "event_type", "value"
    )
    path, log = scratch_path(spark, "days"), scratch_path(spark, "days-log")
    return typed(incremental.run_latest(totals, ["day", "event_type"], path, log))


def stream_daily_late(spark: SparkSession, sf: str) -> DataFrame:
    """The event stream in four deliveries that each span all days: the first is in time, most of the others late."""
    folder, path, log = (scratch_path(spark, name) for name in ("events", "late", "late-log"))
    events = trade.table(spark, sf, "events").withColumn("value", F.col("value").cast(n.MONEY))
    for number in range(4):
        part = events.filter(F.pmod("event_id", F.lit(4)) == number).select("ts", "event_type", "value")
        part.write.mode("append").parquet(folder)
        rows = spark.readStream.schema(part.schema).parquet(folder)
        made = incremental.stream_daily_late(rows, "ts", "event_type", "value", path, log, dt.timedelta(days=2))
    both = made.totals.withColumn("outcome", F.lit("in time")).unionByName(made.corrections.withColumn("outcome", F.lit("late")))
    return typed(both)


def stream_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Users of the event stream, each once: they are remembered for as long as the events span."""
    events = trade.table(spark, sf, "events")
    days = events.agg(F.coalesce(F.datediff(F.max("ts"), F.min("ts")), F.lit(0)).alias("n")).first()["n"]
    unique = incremental.stream_unique(_events(spark, sf), "user_id", "ts", f"{days + 1} days", "event_id").select("user_id")
    return incremental.run_available(unique, scratch_path(spark, "users"), scratch_path(spark, "users-log"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q4_product_type_profitability": _question(bi.product_type_profitability),
    "q1_top_editions_by_region": _question(bi.top_editions_by_region),
    "q2_author_roi": _question(bi.author_roi),
    "q3_channel_efficiency": _question(bi.channel_efficiency),
    "q5_monthly_trend": _question(bi.monthly_trend),
    "q6_dc_ranking": _question(bi.dc_ranking),
    "q7_formatted_report": q7_formatted_report,
    "q7_formatted_channels": q7_formatted_channels,
    "m1_monthly_sales_summary": _rollup("monthly_sales_summary"),
    "m2_daily_dc_performance": _rollup("daily_dc_performance"),
    "m3_quarterly_author_profit": _rollup("quarterly_author_profit"),
    "m4_vendor_cost_analysis": m4_vendor_cost_analysis,
    "m5_channel_performance": _rollup("channel_performance"),
    "m6_rollup_refresh": rollup_refresh,
    "m6_rollup_refresh_months": rollup_refresh_months,
    "m6_delta_monthly_sales": lambda spark, sf: typed(_delta("monthly_sales_summary")(spark, sf)),
    "m6_delta_daily_dc": lambda spark, sf: typed(_delta("daily_dc_performance")(spark, sf)),
    "m6_delta_vendor_cost": m6_delta_vendor_cost,
    "m6_delta_channel": lambda spark, sf: typed(_delta("channel_performance")(spark, sf)),
    "calendar_dim": calendar_dim,
    "calendar_report": calendar_report,
    "calendar_easter": calendar_easter,
    "parse_dates_multi_format": parse_dates_multi_format,
    "extract_metadata": extract_metadata,
    "staging_roundtrip": staging_roundtrip,
    "archive_split": archive_split,
    "archived_total": archived_total,
    "unprocessed_rows": unprocessed_rows,
    "quality_findings": quality_findings,
    "row_verdicts": row_verdicts,
    "duplicate_keys": duplicate_keys,
    "orphan_keys": orphan_keys,
    "constraint_violations": constraint_violations,
    "daily_violations": daily_violations,
    "dimension_violations": dimension_violations,
    "discount_imputed": discount_imputed,
    "first_valid_sales": first_valid_sales,
    "first_valid_existing": first_valid_existing,
    "surrogate_keys": surrogate_keys,
    "fact_key_density": fact_key_density,
    "scd2_history": scd2_history,
    "scd2_merge": scd2_merge,
    "scd2_late": scd2_late,
    "dim_author": dim_author,
    "dim_vendor": dim_vendor,
    "dim_dc": dim_dc,
    "dim_product": dim_product,
    "station_vendor": station_vendor,
    "fact_sales": fact_sales,
    "fact_sales_rejected": fact_sales_rejected,
    "fact_daily": fact_daily,
    "fact_daily_rejected": fact_daily_rejected,
    "fact_sink_months": fact_sink_months,
    "fact_sales_first_center": fact_sales_first_center,
    "seed_codes": seed_codes,
    "load_summary": load_summary,
    "incremental_load": incremental_load,
    "incremental_daily": incremental_daily,
    "archived_load": archived_load,
    "key_index": key_index,
    "load_log": load_log,
    "exchange_rate_lookup": exchange_rate_lookup,
    "correlations": correlations,
    "outliers": outliers,
    "outliers_iqr": outliers_iqr,
    "trend_forecast": trend_forecast,
    "dc_percentile": dc_percentile,
    "vendor_trend": vendor_trend,
    "author_features": author_features,
    "kmeans_segments": kmeans_segments,
    "exchange_rates_loaded": exchange_rates_loaded,
    "staging_emptied": staging_emptied,
    "audit_columns": audit_columns,
    "stream_daily": stream_daily,
    "stream_daily_late": stream_daily_late,
    "stream_unique": stream_unique,
}
