"""The six profitability questions. Numbers stay typed; ``report`` turns them into texts.

Like the rollups, each question reduces the fact by surrogate keys before it joins a dimension.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomart.functions import numeric as n
from foliomart.functions.dates import as_timestamp, window_start
from foliomart.functions.display import format_report
from foliomart.operators.lookups import view
from foliomart.plans.rollups import average, n_rows, partial, total, with_days

_SUMS = ["quantity_sold", "net_amount_gbp", "total_cost_gbp", "gross_profit_gbp"]
UP, DOWN, LEVEL = "↑", "↓", "→"


def _last_year(as_of: dt.date | dt.datetime) -> int:
    return int(window_start(as_of).strftime("%Y%m%d"))


def _years_back(as_of: dt.date | dt.datetime, years: int) -> int:
    return (as_timestamp(as_of).year - years) * 10000 + 101


def top_editions_by_region(
    fact: DataFrame, dims: dict, as_of: dt.date | dt.datetime, k: int = 5, version: str = "as_recorded"
) -> DataFrame:
    """Best editions per region by average margin over the last twelve months."""
    reduced = partial(
        with_days(fact, dims["time"], [], _last_year(as_of)),
        ["product_key", "dc_key", "time_key"],
        ["net_amount_gbp", "total_cost_gbp", "gross_profit_gbp"],
        ["gross_margin_pct"],
    )
    product = view(dims["product"], "product_key", "edition_id", version)
    center = view(dims["dc"], "dc_key", "station_code", version)
    edition = ["edition_id", "product_title", "station_region"]
    sold = (
        reduced.join(product.select("product_key", "edition_id", "product_title"), "product_key")
        .join(center.select("dc_key", "station_region"), "dc_key")
        .groupBy(*edition)
        .agg(
            total("net_amount_gbp").alias("total_revenue"),
            total("total_cost_gbp").alias("total_cost"),
            total("gross_profit_gbp").alias("total_profit"),
            average("gross_margin_pct").alias("avg_margin_pct"),
            F.count_distinct("time_key").alias("days_sold"),
        )
    )
    best = Window.partitionBy("station_region").orderBy(
        F.desc_nulls_first("avg_margin_pct"), "edition_id", "product_title"
    )
    return (
        sold.withColumn("rank_in_region", F.row_number().over(best))
        .filter(F.col("rank_in_region") <= k)
        .select(
            "station_region", "edition_id", "product_title", "total_revenue", "total_cost",
            "total_profit", "avg_margin_pct", "days_sold", "rank_in_region",
        )
        .orderBy(F.asc_nulls_last("station_region"), "rank_in_region")
    )


def author_roi(
    fact: DataFrame, dims: dict, as_of: dt.date | dt.datetime, version: str = "as_recorded"
) -> DataFrame:
    """Revenue and profit per author and edition over the last twelve months.

    The source has no advances, so revenue per edition stands in for the return.
    """
    reduced = partial(
        with_days(fact, dims["time"], [], _last_year(as_of)),
        ["author_key", "product_key"],
        _SUMS,
        ["gross_margin_pct"],
    )
    author = view(dims["author"], "author_key", "author_id", version).select(
        "author_key", "author_id", F.col("full_name").alias("author_name"), "primary_genre"
    )
    product = view(dims["product"], "product_key", "edition_id", version)
    return (
        reduced.join(product.select("product_key", "edition_id"), "product_key")
        .join(author, "author_key")
        .groupBy("author_id", "author_name", "primary_genre")
        .agg(
            F.count_distinct("edition_id").alias("number_of_editions"),
            total("net_amount_gbp").alias("total_revenue"),
            total("gross_profit_gbp").alias("total_profit"),
            average("gross_margin_pct").alias("avg_margin_pct"),
            total("quantity_sold").alias("total_units_sold"),
        )
        .withColumns(
            {
                "revenue_per_edition": n.ratio(F.col("total_revenue"), F.col("number_of_editions")),
                "profit_per_edition": n.ratio(F.col("total_profit"), F.col("number_of_editions")),
            }
        )
        .select(
            "author_id", "author_name", "primary_genre", "number_of_editions", "total_revenue",
            "total_profit", "revenue_per_edition", "profit_per_edition", "avg_margin_pct",
            "total_units_sold",
        )
        .orderBy(F.desc_nulls_first("total_profit"), "author_id")
    )


def channel_efficiency(fact: DataFrame, dims: dict, as_of: dt.date | dt.datetime) -> DataFrame:
    """Revenue per pound of discount by channel and quarter, this year and the last.

    The source has no marketing spend; the discounts stand in for it.
    """
    period = ["year", "quarter_name"]
    reduced = partial(
        with_days(fact, dims["time"], period, _years_back(as_of, 1)),
        [*period, "channel_key"],
        ["quantity_sold", "discount_amount_gbp", "net_amount_gbp", "gross_profit_gbp"],
        ["gross_margin_pct", "discount_rate"],
    )
    channel = ["channel_code", "channel_name", "channel_type"]
    return (
        reduced.join(dims["channel"].select("channel_key", *channel), "channel_key")
        .groupBy(*channel, *period)
        .agg(
            n_rows().alias("transaction_count"),
            total("quantity_sold").alias("total_units"),
            total("net_amount_gbp").alias("net_revenue"),
            total("discount_amount_gbp").alias("total_discounts"),
            total("gross_profit_gbp").alias("total_profit"),
            average("gross_margin_pct").alias("avg_margin_pct"),
            (average("discount_rate") * 100).alias("avg_discount_pct"),
        )
        .withColumns(
            {
                "period": F.concat_ws(" ", F.col("year").cast("string"), "quarter_name"),
                "revenue_per_transaction": n.ratio(F.col("net_revenue"), F.col("transaction_count")),
                "revenue_per_discount": n.ratio(F.col("net_revenue"), F.col("total_discounts")),
            }
        )
        .orderBy(F.desc("year"), "quarter_name", F.desc_nulls_first("net_revenue"), "channel_code")
        .select(
            "channel_name", "channel_type", "period", "transaction_count", "total_units",
            "net_revenue", "total_discounts", "total_profit", "avg_margin_pct", "avg_discount_pct",
            "revenue_per_transaction", "revenue_per_discount",
        )
    )


def product_type_profitability(fact: DataFrame, dims: dict, as_of: dt.date | dt.datetime) -> DataFrame:
    """Product types by year, this year and the two before."""
    reduced = partial(
        with_days(fact, dims["time"], ["year"], _years_back(as_of, 2)),
        ["year", "product_type_key"],
        _SUMS,
        ["gross_margin_pct"],
    )
    kind = ["product_type_name", "is_physical"]
    return (
        reduced.join(dims["product_type"].select("product_type_key", *kind), "product_type_key")
        .groupBy(*kind, "year")
        .agg(
            n_rows().alias("transaction_count"),
            total("quantity_sold").alias("total_units"),
            total("net_amount_gbp").alias("total_revenue"),
            total("total_cost_gbp").alias("total_cost"),
            total("gross_profit_gbp").alias("total_profit"),
            average("gross_margin_pct").alias("avg_margin_pct"),
        )
        .withColumns(
            {
                "revenue_per_unit": n.ratio(F.col("total_revenue"), F.col("total_units")),
                "profit_per_unit": n.ratio(F.col("total_profit"), F.col("total_units")),
            }
        )
        .orderBy(F.desc("year"), F.desc_nulls_first("total_revenue"), "product_type_name")
    )


def monthly_trend(fact: DataFrame, dims: dict, as_of: dt.date | dt.datetime) -> DataFrame:
    """Months of this year and the last with growth against the month before.

    The window runs over one row per month, after aggregation.
    """
    month = ["year", "month_number", "month_name"]
    monthly = (
        partial(
            with_days(fact, dims["time"], month, _years_back(as_of, 1)),
            month,
            ["net_amount_gbp", "total_cost_gbp", "gross_profit_gbp"],
            ["gross_margin_pct"],
        )
        .groupBy(*month)
        .agg(
            total("net_amount_gbp").alias("revenue"),
            total("total_cost_gbp").alias("cost"),
            total("gross_profit_gbp").alias("profit"),
            average("gross_margin_pct").alias("margin_pct"),
        )
    )
    in_order = Window.orderBy("year", "month_number")
    before = F.lag("revenue").over(in_order)
    profit_before = F.lag("profit").over(in_order)
    return (
        monthly.withColumns({"_before": before, "_profit_before": profit_before})
        .select(
            "year",
            "month_number",
            F.concat_ws(" ", F.col("year").cast("string"), "month_name").alias("month"),
            "revenue",
            "cost",
            "profit",
            "margin_pct",
            n.growth_pct(F.col("revenue"), F.col("_before")).alias("revenue_growth_pct"),
            n.growth_pct(F.col("profit"), F.col("_profit_before")).alias("profit_growth_pct"),
            trend_sign(F.col("revenue"), F.col("_before")).alias("trend"),
        )
        .orderBy("year", "month_number")
    )


def trend_sign(now: Column, before: Column) -> Column:
    return F.when(now > before, UP).when(now < before, DOWN).otherwise(LEVEL)


def dc_ranking(
    fact: DataFrame, dims: dict, as_of: dt.date | dt.datetime, version: str = "as_recorded"
) -> DataFrame:
    """Distribution centers by profit over the last twelve months.

    The rank runs over one row per center, after aggregation.
    """
    reduced = partial(
        with_days(fact, dims["time"], [], _last_year(as_of)),
        ["dc_key"],
        ["quantity_sold", "net_amount_gbp", "gross_profit_gbp"],
        ["gross_margin_pct"],
    )
    station = ["station_code", "station_name", "station_region"]
    center = view(dims["dc"], "dc_key", "station_code", version)
    by_center = (
        reduced.join(center.select("dc_key", *station), "dc_key")
        .groupBy(*station)
        .agg(
            n_rows().alias("transaction_count"),
            total("quantity_sold").alias("total_units"),
            total("net_amount_gbp").alias("total_revenue"),
            total("gross_profit_gbp").alias("total_profit"),
            average("gross_margin_pct").alias("avg_margin_pct"),
        )
    )
    return (
        by_center.withColumn(
            "profit_rank", F.rank().over(Window.orderBy(F.desc_nulls_first("total_profit")))
        )
        .withColumn(
            "revenue_per_transaction", n.ratio(F.col("total_revenue"), F.col("transaction_count"))
        )
        .orderBy(F.desc_nulls_first("total_profit"), "station_code")
    )


# Display names, and which columns print as money, percent or plain number.
REPORTS = {
    "top_editions_by_region": {
        "money": ["total_revenue", "total_cost", "total_profit"],
        "pct": ["avg_margin_pct"],
        "names": {
            "station_region": "Region", "edition_id": "Edition ID", "product_title": "Product Title",
            "total_revenue": "Total Revenue", "total_cost": "Total Cost",
            "total_profit": "Gross Profit", "avg_margin_pct": "Avg Margin %", "days_sold": "Days Sold",
        },
        "drop": ["rank_in_region"],
    },
    "author_roi": {
        "money": ["total_revenue", "total_profit", "revenue_per_edition", "profit_per_edition"],
        "pct": ["avg_margin_pct"],
        "names": {
            "author_id": "Author ID", "author_name": "Author Name", "primary_genre": "Genre",
            "number_of_editions": "# Editions", "total_revenue": "Total Revenue",
            "total_profit": "Total Profit", "revenue_per_edition": "Revenue per Edition",
            "profit_per_edition": "Profit per Edition", "avg_margin_pct": "Avg Margin %",
            "total_units_sold": "Units Sold",
        },
    },
    "channel_efficiency": {
        "money": ["net_revenue", "total_discounts", "total_profit", "revenue_per_transaction"],
        "pct": ["avg_margin_pct", "avg_discount_pct"],
        "plain": ["revenue_per_discount"],
        "names": {
            "channel_name": "Channel", "channel_type": "Type", "period": "Period",
            "transaction_count": "Transactions", "total_units": "Units Sold",
            "net_revenue": "Net Revenue", "total_discounts": "Total Discounts",
            "total_profit": "Gross Profit", "avg_margin_pct": "Avg Margin %",
            "avg_discount_pct": "Avg Discount %", "revenue_per_transaction": "Revenue per Transaction",
            "revenue_per_discount": "Revenue per £ Discount",
        },
    },
    "product_type_profitability": {
        "money": ["total_revenue", "total_cost", "total_profit", "revenue_per_unit", "profit_per_unit"],
        "pct": ["avg_margin_pct"],
        "names": {
            "product_type_name": "Product Type", "is_physical": "Physical", "year": "Year",
            "transaction_count": "Transactions", "total_units": "Units Sold",
            "total_revenue": "Total Revenue", "total_cost": "Total Cost",
            "total_profit": "Gross Profit", "avg_margin_pct": "Avg Margin %",
            "revenue_per_unit": "Avg Revenue per Unit", "profit_per_unit": "Avg Profit per Unit",
        },
    },
    "monthly_trend": {
        "money": ["revenue", "cost", "profit"],
        "pct": ["margin_pct", "revenue_growth_pct", "profit_growth_pct"],
        "names": {
            "month": "Month", "revenue": "Revenue", "cost": "Cost", "profit": "Profit",
            "margin_pct": "Margin %", "revenue_growth_pct": "Revenue Growth %",
            "profit_growth_pct": "Profit Growth %", "trend": "Trend",
        },
        "drop": ["year", "month_number"],
    },
    "dc_ranking": {
        "money": ["total_revenue", "total_profit", "revenue_per_transaction"],
        "pct": ["avg_margin_pct"],
        "names": {
            "station_code": "DC Code", "station_name": "DC Name", "station_region": "Region",
            "transaction_count": "Transactions", "total_units": "Units Sold",
            "total_revenue": "Total Revenue", "total_profit": "Gross Profit",
            "avg_margin_pct": "Avg Margin %", "profit_rank": "Profit Rank",
            "revenue_per_transaction": "Revenue per Transaction",
        },
    },
}


def report(name: str, result: DataFrame) -> DataFrame:
    """A question's result as it is shown to people."""
    layout = dict(REPORTS[name])
    return format_report(result.drop(*layout.pop("drop", [])), **layout)
