"""Versioned dimensions from the meta extract, seeded code tables and unknown members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliomart.functions import numeric as n
from foliomart.operators.scd2 import scd2_merge
from foliomart.schemas import (
    CHANNEL_SEED,
    CURRENCY_SEED,
    DIM_AUTHOR,
    DIM_CHANNEL,
    DIM_CURRENCY,
    DIM_DC,
    DIM_PRODUCT,
    DIM_PRODUCT_TYPE,
    DIM_VENDOR,
    EXCHANGE_RATE,
    FIRST_DIM_KEY,
    PRODUCT_TYPE_SEED,
    UNKNOWN_KEY,
)
from foliomart.session import few_rows

# Fixed value: country of centers, which the source leaves out.
HOME_COUNTRY = "UK"


def _distinct(meta: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    """One row per natural key; of several variants the smallest, so reruns agree.

    Equal rows are made one by hash first: the minimum of texts is found by sorting, and a meta extract repeats
    a member on many rows. The filter on the count keeps Spark from taking that step out again.
    """
    named = meta.select(*[c.alias(name) for name, c in columns.items()]).filter(F.col(key).isNotNull())
    rest = [c for c in columns if c != key]
    once = named.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 0)
    return once.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, "_r.*")


def author_rows(meta: DataFrame) -> DataFrame:
    return _distinct(
        meta,
        "author_id",
        {
            "author_id": F.col("author_id"),
            "first_name": F.col("author_first_name"),
            "last_name": F.col("author_last_name"),
            "full_name": F.concat_ws(" ", "author_first_name", "author_last_name"),
            "country": F.col("author_country"),
            "primary_genre": F.col("author_primary_genre"),
        },
    )


def vendor_rows(meta: DataFrame) -> DataFrame:
    unset = F.lit(None).cast(n.PERCENT)
    return _distinct(
        meta,
        "vendor_id",
        {
            "vendor_id": F.col("vendor_id"),
            "vendor_name": F.col("vendor_name"),
            "vendor_score": n.fit(F.col("vendor_score"), n.SCORE),
            "service_type_1": F.col("vendor_svc_type_1"),
            "service_quality_1": F.col("vendor_svc_qual_1"),
            "service_type_2": F.col("vendor_svc_type_2"),
            "service_quality_2": F.col("vendor_svc_qual_2"),
            "avg_delivery_days": unset,
            "on_time_percentage": unset,
            "cost_variance_pct": unset,
        },
    )


def dc_rows(meta: DataFrame) -> DataFrame:
    text = F.lit(None).cast("string")
    return _distinct(
        meta,
        "station_code",
        {
            "station_code": F.col("station_id"),
            "station_name": F.col("station_name"),
            "station_region": F.col("station_region"),
            "station_country": F.lit(HOME_COUNTRY),
            "manager_id": F.col("station_mgr"),
            "station_address": F.col("station_address"),
            "postcode": F.nullif(F.regexp_extract("station_address", r"([A-Z]+[0-9]+ [0-9][A-Z]+)$", 1), F.lit("")),
            "region_code": text,
            "region_name": text,
        },
    )


def product_rows(meta: DataFrame, author: DataFrame, vendor: DataFrame) -> DataFrame:
    """Editions with the current keys of their author and vendor (-1 if missing)."""
    editions = _distinct(
        meta,
        "edition_id",
        {
            "edition_id": F.col("publication_ed"),
            "product_title": F.col("publication_title"),
            "product_category": F.col("publication_cat"),
            "product_language": F.col("publication_lang"),
            "author_id": F.coalesce("publication_author", "author_id"),
            "vendor_id": F.col("vendor_id"),
        },
    )
    authors = author.filter(F.col("is_current") == "Y").select("author_id", "author_key")
    vendors = vendor.filter(F.col("is_current") == "Y").select("vendor_id", "vendor_key")
    missing = F.lit(UNKNOWN_KEY).cast("bigint")
    return (
        editions.join(authors, "author_id", "left")
        .join(vendors, "vendor_id", "left")
        .select(
            "edition_id", "product_title", "product_category", "product_language",
            F.coalesce("author_key", missing).alias("author_key"),
            F.coalesce("vendor_key", missing).alias("vendor_key"),
        )
    )


# dimension -> (schema, surrogate key, natural key)
VERSIONED = {
    "author": (DIM_AUTHOR, "author_key", "author_id"),
    "vendor": (DIM_VENDOR, "vendor_key", "vendor_id"),
    "dc": (DIM_DC, "dc_key", "station_code"),
    "product": (DIM_PRODUCT, "product_key", "edition_id"),
}
VERSION_COLUMNS = [
    "effective_date", "expiry_date", "is_current", "record_version",
    "created_date", "created_by", "modified_date", "modified_by",
]


def _merge(
    name: str, incoming: DataFrame, effective: Column, existing: DataFrame | None, work: str | None
) -> DataFrame:
    schema, key, natural = VERSIONED[name]
    tracked = [f.name for f in schema.fields if f.name not in (key, natural, *VERSION_COLUMNS)]
    known = existing
    if known is None:
        known = few_rows(incoming.sparkSession, [], schema)
    merged = scd2_merge(known, incoming, natural, tracked, effective, key, FIRST_DIM_KEY, work and f"{work}/{name}")
    return merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def dim_author(
    meta: DataFrame, effective: Column, existing: DataFrame | None = None, work: str | None = None
) -> DataFrame:
    return _merge("author", author_rows(meta), effective, existing, work)


def dim_vendor(
    meta: DataFrame, effective: Column, existing: DataFrame | None = None, work: str | None = None
) -> DataFrame:
    return _merge("vendor", vendor_rows(meta), effective, existing, work)


def dim_dc(
    meta: DataFrame, effective: Column, existing: DataFrame | None = None, work: str | None = None
) -> DataFrame:
    return _merge("dc", dc_rows(meta), effective, existing, work)


def dim_product(
    meta: DataFrame,
    author: DataFrame,
    vendor: DataFrame,
    effective: Column,
    existing: DataFrame | None = None,
    work: str | None = None,
) -> DataFrame:
    return _merge("product", product_rows(meta, author, vendor), effective, existing, work)


def station_vendor(meta: DataFrame) -> DataFrame:
    """Which vendor serves a station; both stand on one meta row."""
    return (
        meta.select(F.col("station_id").alias("station_code"), "vendor_id")
        .filter(F.col("station_code").isNotNull() & F.col("vendor_id").isNotNull())
        .distinct()
    )


def _seed(spark: SparkSession, rows: list[tuple], columns: list[str], schema: T.StructType, key: str) -> DataFrame:
    keyed = [(FIRST_DIM_KEY + i, *row) for i, row in enumerate(rows)]
    made = spark.createDataFrame(keyed, [key, *columns])
    audit = {"created_date": F.current_timestamp(), "created_by": F.current_user()}
    return made.select(
        *[
            audit.get(f.name, F.col(f.name) if f.name in made.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def dim_channel(spark: SparkSession) -> DataFrame:
    columns = ["channel_code", "channel_name", "channel_type"]
    return _seed(spark, CHANNEL_SEED, columns, DIM_CHANNEL, "channel_key")


def dim_product_type(spark: SparkSession) -> DataFrame:
    columns = ["product_type_code", "product_type_name", "is_physical"]
    return _seed(spark, PRODUCT_TYPE_SEED, columns, DIM_PRODUCT_TYPE, "product_type_key")


def dim_currency(spark: SparkSession) -> DataFrame:
    columns = ["currency_code", "currency_name", "currency_symbol", "is_base_currency", "decimal_places"]
    return _seed(spark, CURRENCY_SEED, columns, DIM_CURRENCY, "currency_key")


def exchange_rates(rates: DataFrame, currency: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rate rows (from_code, to_code, rate_date, exchange_rate, rate_source) as the bridge table, and
    the rows that do not fit it, with a reason."""
    codes = currency.select("currency_code", "currency_key")
    source = codes.toDF("from_code", "from_currency_key")
    target = codes.toDF("to_code", "to_currency_key")
    day = F.col("rate_date").try_cast("date")
    rate = n.fit(F.col("exchange_rate"), n.RATE)
    joined = rates.join(source, "from_code", "left").join(target, "to_code", "left")
    reason = (
        F.when(F.col("from_currency_key").isNull(), "UNKNOWN_FROM_CURRENCY")
        .when(F.col("to_currency_key").isNull(), "UNKNOWN_TO_CURRENCY")
        .when(day.isNull(), "NO_DATE")
        .when(rate.isNull(), "RATE_DOES_NOT_FIT")
        .when(rate <= 0, "RATE_NOT_POSITIVE")
    )
    tagged = joined.withColumn("reject_reason", reason)
    fits = tagged.filter(F.col("reject_reason").isNull())
    made = fits.select(
        F.xxhash64("from_currency_key", "to_currency_key", day).alias("exchange_rate_key"),
        "from_currency_key",
        "to_currency_key",
        F.date_format(day, "yyyyMMdd").cast("int").alias("time_key"),
        rate.alias("exchange_rate"),
        day.alias("rate_date"),
        "rate_source",
        F.current_timestamp().alias("created_date"),
        F.current_user().alias("created_by"),
    )
    made = made.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EXCHANGE_RATE.fields])
    refused = tagged.filter(F.col("reject_reason").isNotNull()).select(*rates.columns, "reject_reason")
    return made, refused


def misfits(meta: DataFrame) -> DataFrame:
    """Vendor scores of meta rows that the dimension cannot hold: (vendor_id, vendor_score)."""
    lost = n.overflowed(F.col("vendor_score"), n.SCORE)
    return meta.filter(lost).select("vendor_id", "vendor_score").distinct()


def with_unknown(dim: DataFrame, key: str) -> DataFrame:
    """Add the member -1 that facts without a match point to."""
    labels = {key: F.lit(UNKNOWN_KEY), "is_current": F.lit("Y"), "record_version": F.lit(1)}
    row = []
    for f in dim.schema.fields:
        if f.name in labels:
            value = labels[f.name]
        elif f.name.endswith("_key"):
            value = F.lit(UNKNOWN_KEY)
        elif f.name.startswith("is_"):
            value = F.lit("N")
        elif f.name in ("created_by", "modified_by", "uk_holiday_name"):
            value = F.lit(None)
        elif isinstance(f.dataType, T.StringType):
            value = F.lit("Unknown")
        else:
            value = F.lit(None)
        row.append(value.cast(f.dataType).alias(f.name))
    return dim.unionByName(dim.sparkSession.range(0, 1, 1, 1).select(*row))
