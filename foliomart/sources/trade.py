"""Trade tables (orders, line items, parts, suppliers) read as warehouse sources.

A line item is a sale, its part an edition, the part's brand an author, the supplier a vendor,
the supplier's nation a distribution center and the order's priority a channel.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomart.functions import numeric as n
from foliomart.operators import dimensions as d
from foliomart.operators.calendar import calendar
from foliomart.operators.facts import build_fact_daily, build_fact_sales
from foliomart.operators.lookups import Star, shuffled_if_large
from foliomart.schemas import staging_schema
from foliomart.session import discard, release, saved, scratch_path
from foliomart.sources.warehouse import write_fact

FIRST_DAY = dt.date(1995, 1, 1)
LAST_DAY = dt.date(2001, 12, 31)
AS_OF = dt.datetime(2001, 8, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _staged(df: DataFrame, source: str, values: dict) -> DataFrame:
    """Select staging columns; the staging id keeps the type it comes with."""
    fields = staging_schema(source).fields
    constants = {
        "load_date": F.lit(AS_OF),
        "validation_status": F.lit("VALID"),
        "processed_flag": F.lit("N"),
    }
    given = {**constants, **values}
    out = [given[fields[0].name].alias(fields[0].name)]
    out += [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields[1:]]
    return df.select(*out)


def staged_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as staged sales."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    # The edition lookup joins on the same text, so rows dealt by it are not shuffled again; adaptive execution
    # may do so to split a hot part.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("ed_id"), "p_type", "p_size", "p_retailprice"
    )
    price = F.col("l_extendedprice").cast(n.MONEY)
    quantity = F.col("l_quantity").cast(n.QUANTITY)
    # Both sides grow with the data, so they are shuffled and never broadcast; adaptive execution
    # splits the partition of a hot order.
    sold = lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    sold = sold.withColumn("ed_id", F.col("l_partkey").cast("string")).join(shuffled_if_large(part), "ed_id")
    currency = F.when(F.col("l_returnflag") == "A", "USD").when(F.col("l_returnflag") == "R", "EUR")
    return _staged(
        sold,
        "raw_sales",
        {
            "stg_sales_id": F.concat_ws(
                "-", "l_orderkey", "l_linenumber", "ed_id", "l_suppkey", price.cast("string")
            ),
            "sale_num": F.concat_ws("-", "l_orderkey", "l_linenumber"),
            "date_stamp": F.date_format("o_orderdate", "yyyy-MM-dd"),
            "date_parsed": F.col("o_orderdate").cast("date"),
            "ed_id": F.col("ed_id"),
            "chnl": F.col("o_orderpriority"),
            "tqty": quantity,
            "uprice": n.fit(price / quantity, n.MONEY),
            "curr": currency.otherwise("GBP"),
            "dscnt": F.nullif(F.col("l_discount"), F.lit(0.0)).cast(n.DISCOUNT),
            "pd": F.col("p_size") * 100,
            "bc": F.col("p_retailprice").cast(n.MONEY),
            "vscr": (F.col("l_tax") * 100).cast(n.SCORE),
            "typ": F.col("p_type"),
            "source_filename": F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string")),
        },
    )


def staged_daily(spark: SparkSession, sf_dir: str, by_supplier: bool = False) -> DataFrame:
    """Line items by ship date, supplier nation (or supplier) and part type as staged daily operations."""
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_type", "p_size", "p_retailprice"
    )
    moved = lines.join(shuffled_if_large(part), "l_partkey").join(supplier_nation(spark, sf_dir), "l_suppkey")
    if by_supplier:
        moved = moved.withColumn("n_name", F.concat(F.lit("V"), F.col("l_suppkey").cast("string")))
    quantity = F.col("l_quantity").cast("decimal(10,0)")
    day = F.col("l_shipdate").cast("date")
    daily = moved.groupBy(day.alias("day"), "n_name", "p_type").agg(
        (F.sum("p_size") * 5).alias("pd"),
        F.sum(F.col("p_retailprice").cast(n.MONEY)).alias("bc"),
        F.sum(quantity).alias("us"),
        F.sum(F.when(F.col("l_returnflag") == "R", quantity)).alias("rv"),
        F.sum(F.col("l_extendedprice").cast(n.MONEY)).alias("rev"),
        (F.min("l_tax") * 100 + 10).alias("tmp"),
        (F.min("l_linenumber") * 10).alias("hmd"),
        (F.max("l_discount") * 100).alias("vscr"),
    )
    return _staged(
        daily,
        "raw_daily",
        {
            "stg_daily_id": F.concat_ws("|", F.col("day").cast("string"), "n_name", "p_type"),
            "date_stamp": F.col("day").cast("string"),
            "date_parsed": F.col("day"),
            "stn_code": F.col("n_name"),
            "typ": F.col("p_type"),
            **{c: F.col(c) for c in ("pd", "bc", "us", "rv", "rev", "tmp", "hmd", "vscr")},
        },
    )


def supplier_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return supplier.join(nation, "s_nationkey").select("l_suppkey", "n_name")


def lead_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier with the lowest number among those that ship a part."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.min("l_suppkey").alias("vendor_key")
    )


def _versioned(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "effective_date": F.lit(FIRST_DAY),
            "expiry_date": F.lit(None).cast("date"),
            "is_current": F.lit("Y"),
            "record_version": F.lit(1),
        }
    )


def star(spark: SparkSession, sf_dir: str) -> Star:
    """Dimensions with the tables' own numbers as surrogate keys.

    The catalogue leaves out parts of size 1 (sheets, not books), so their sales find no edition.
    """
    part = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    supplier = table(spark, sf_dir, "supplier")
    brand_key = F.substring("p_brand", 7, 10).cast("bigint")
    product = part.filter(F.col("p_size") > 1).join(lead_supplier(spark, sf_dir), "p_partkey", "left").select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_partkey").cast("string").alias("edition_id"),
        F.col("p_name").alias("product_title"),
        F.col("p_type").alias("product_category"),
        F.lit("EN").alias("product_language"),
        brand_key.alias("author_key"),
        F.coalesce("vendor_key", F.lit(-1)).cast("bigint").alias("vendor_key"),
    )
    author = part.groupBy("p_brand").agg(F.min("p_type").alias("primary_genre")).select(
        brand_key.alias("author_key"),
        F.col("p_brand").alias("author_id"),
        F.concat(F.lit("Author "), brand_key.cast("string")).alias("full_name"),
        "primary_genre",
    )
    dc = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("dc_key"),
        F.col("n_name").alias("station_code"),
        F.concat("n_name", F.lit(" DC")).alias("station_name"),
        F.col("r_name").alias("station_region"),
    )
    vendor = supplier.select(
        F.col("s_suppkey").alias("vendor_key"),
        F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
    )
    priority = F.col("o_orderpriority")
    channel = orders.select("o_orderpriority").distinct().select(
        F.substring(priority, 1, 1).cast("bigint").alias("channel_key"),
        priority.alias("channel_code"),
        F.substring(priority, 3, 50).alias("channel_name"),
        F.when(F.substring(priority, 1, 1).isin("1", "2"), "Online").otherwise("Physical").alias("channel_type"),
    )
    product_type = part.groupBy("p_type").agg(F.min("p_partkey").alias("product_type_key")).select(
        "product_type_key",
        F.upper(F.substring("p_type", 1, 3)).alias("product_type_code"),
        F.col("p_type").alias("product_type_name"),
        F.when(F.col("p_type") == "ECONOMY", "N").otherwise("Y").alias("is_physical"),
    )
    bridge = (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("station_code"))
        .agg(F.concat(F.lit("V"), F.min("s_suppkey").cast("string")).alias("vendor_id"))
    )
    versioned = {"product": product, "author": author, "dc": dc, "vendor": vendor}
    plain = {"channel": channel, "product_type": product_type, "currency": d.dim_currency(spark)}
    keys = {"dc": "dc_key", "product_type": "product_type_key"}
    made = {name: _versioned(dim) for name, dim in versioned.items()} | plain
    made = {name: d.with_unknown(dim, keys.get(name, f"{name}_key")) for name, dim in made.items()}
    return Star(made, time=calendar(spark, FIRST_DAY, LAST_DAY), station_vendor=bridge)


def center_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which center a sale belongs to: each supplier delivers its own file."""
    return supplier_nation(spark, sf_dir).select(
        F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string")).alias("source_filename"),
        F.col("n_name").alias("station_code"),
    )


# Tables of this application's warehouse, written when first asked for.
_stored: dict[tuple[str, ...], Star | DataFrame] = {}


def stored_star(spark: SparkSession, sf_dir: str) -> Star:
    """The dimensions as the warehouse keeps them: written once per application, then read."""
    key = (spark.sparkContext.applicationId, sf_dir, "dim")
    if key not in _stored:
        path = scratch_path(spark, "dim")
        made = star(spark, sf_dir)
        with ThreadPoolExecutor(4) as pool:
            read = pool.map(lambda name: (name, saved(made[name], f"{path}/{name}")), made)
        _stored[key] = Star(read)
    return _stored[key]


def sales(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    """Sales fact and rejected rows, built from the trade tables."""
    return build_fact_sales(
        staged_sales(spark, sf_dir), stored_star(spark, sf_dir), batch_id=1,
        dc_map=center_map(spark, sf_dir), **options,
    )


def daily(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    """Daily operations fact and rejected rows, built from the trade tables."""
    return build_fact_daily(
        staged_daily(spark, sf_dir), stored_star(spark, sf_dir), batch_id=1, **options
    )


def stored_fact(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fact as the warehouse keeps it: written by month once per application, then read."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path, work = scratch_path(spark, name), scratch_path(spark, f"{name}-work")
        fact, _ = {"fact_sales": sales, "fact_daily": daily}[name](spark, sf_dir, work=work)
        write_fact(fact, path, by_day=True)
        # nobody asked for the rejects, which would read it too
        discard(spark, work)
        release(spark)
        _stored[key] = spark.read.parquet(path)
    return _stored[key]


def meta_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with every supplier that ships them, its nation and the brand as staged meta rows.

    A part that nobody ships has one row without a supplier.
    """
    part = table(spark, sf_dir, "part")
    shipped = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")
    ).distinct()
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    makers = supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    rows = part.join(shipped.join(makers, "s_suppkey"), "p_partkey", "left")
    brand = F.substring("p_brand", 7, 10)
    return rows.select(
        F.col("n_name").alias("station_id"),
        F.concat("n_name", F.lit(" DC")).alias("station_name"),
        F.col("r_name").alias("station_region"),
        F.concat(F.lit("MGR"), F.col("n_nationkey").cast("string")).alias("station_mgr"),
        F.concat(F.lit("1 High Street, E"), F.col("n_nationkey").cast("string"), F.lit(" 8ZA")).alias("station_address"),
        F.concat(F.lit("V"), F.col("s_suppkey").cast("string")).alias("vendor_id"),
        F.col("s_name").alias("vendor_name"),
        (F.abs("s_acctbal") / 1000).alias("vendor_score"),
        F.lit("Paper").alias("vendor_svc_type_1"),
        F.lit("A").alias("vendor_svc_qual_1"),
        F.lit(None).cast("string").alias("vendor_svc_type_2"),
        F.lit(None).cast("string").alias("vendor_svc_qual_2"),
        F.col("p_partkey").cast("string").alias("publication_ed"),
        F.col("p_name").alias("publication_title"),
        F.col("p_type").alias("publication_cat"),
        F.lit("EN").alias("publication_lang"),
        F.col("p_brand").alias("publication_author"),
        F.col("p_brand").alias("author_id"),
        F.lit("Author").alias("author_first_name"),
        brand.alias("author_last_name"),
        F.lit("UK").alias("author_country"),
        F.col("p_type").alias("author_primary_genre"),
    )
