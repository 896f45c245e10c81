"""The five pre-aggregated rollups.

Each one reduces the fact by calendar columns and surrogate keys first (with map-side partial
sums), joins the dimensions to that reduced frame, and groups again by the shown attributes. So
no dimension join sees fact rows, whatever key is hot or dimension large. Sums and counts are
exact and averages are one final division, so the order of the partial sums does not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomart.functions import numeric as n
from foliomart.operators.lookups import view
from foliomart.schemas import schema_of
from foliomart.session import discard, few_rows
from foliomart.sources.warehouse import Warehouse

_TOTAL = "decimal(28,2)"


def with_days(fact: DataFrame, cal: DataFrame, columns: list[str], first_day: int | None = None) -> DataFrame:
    """Fact rows with calendar columns, from ``first_day`` (YYYYMMDD) on.

    The calendar has one row per day and is broadcast. The bound is also put on the fact's own
    columns, where it prunes months and row groups.
    """
    if first_day is not None:
        cal = cal.filter(F.col("time_key") >= first_day)
        fact = fact.filter(F.col("time_key") >= first_day)
        if "year_month" in fact.columns:
            fact = fact.filter(F.col("year_month") >= first_day // 100)
    return fact.join(F.broadcast(cal.select("time_key", *columns)), "time_key")


def partial(df: DataFrame, keys: list[str], sums: list[str], avgs: list[str]) -> DataFrame:
    """One row per key set: row count, sums, and sum and count of the averaged columns."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_s_{c}") for c in dict.fromkeys([*sums, *avgs])],
        *[F.count(c).alias(f"_c_{c}") for c in avgs],
    )


def n_rows() -> Column:
    return F.sum("_n")


def total(column: str) -> Column:
    return F.sum(f"_s_{column}").cast(_TOTAL)


def average(column: str) -> Column:
    return n.ratio(F.sum(f"_s_{column}"), F.sum(f"_c_{column}"))


def _monthly_states(fact: DataFrame, dims: dict) -> DataFrame:
    month = ["year", "month_number", "month_name"]
    return partial(
        with_days(fact, dims["time"], month),
        [*month, "product_key", "channel_key", "product_type_key"],
        ["quantity_sold", "net_amount_gbp", "total_cost_gbp", "gross_profit_gbp"],
        ["gross_margin_pct", "discount_rate"],
    )


def _monthly_shown(reduced: DataFrame, dims: dict, version: str) -> DataFrame:
    month = ["year", "month_number", "month_name"]
    shown = ["edition_id", "product_title", "channel_name", "product_type_name"]
    product = view(dims["product"], "product_key", "edition_id", version).select("product_key", "edition_id", "product_title")
    alike = F.count(F.lit(1)).over(Window.partitionBy("edition_id", "product_title"))
    named = (
        reduced.join(product.withColumn("_alike", alike), "product_key")
        .join(dims["channel"].select("channel_key", "channel_name"), "channel_key")
        .join(dims["product_type"].select("product_type_key", "product_type_name"), "product_type_key")
    )
    # an edition under one key is grouped where the join by that key left its rows, the others are shuffled once more
    alone = named.filter(F.col("_alike") == 1).groupBy("product_key", *month, *shown)
    several = named.filter(F.col("_alike") > 1).groupBy(*month, *shown)
    figures = [
        n_rows().alias("transaction_count"),
        total("quantity_sold").alias("total_quantity"),
        total("net_amount_gbp").alias("total_revenue_gbp"),
        total("total_cost_gbp").alias("total_cost_gbp"),
        total("gross_profit_gbp").alias("total_profit_gbp"),
        average("gross_margin_pct").alias("avg_margin_pct"),
        average("discount_rate").alias("avg_discount_rate"),
    ]
    return alone.agg(*figures).drop("product_key").unionByName(several.agg(*figures))


_DAILY_AVERAGES = {
    "return_rate_pct": "avg_return_rate",
    "print_run_utilization": "avg_utilization",
    "vendor_score": "avg_vendor_score",
    "temperature_celsius": "avg_temperature",
    "humidity_pct": "avg_humidity",
}


def _daily_states(fact: DataFrame, dims: dict) -> DataFrame:
    day = ["full_date", "year", "month_number"]
    return partial(
        with_days(fact, dims["time"], day),
        [*day, "dc_key", "product_type_key"],
        ["units_sold", "returns_qty", "net_units", "revenue_gbp", "gross_profit_gbp"],
        list(_DAILY_AVERAGES),
    )


def _daily_shown(reduced: DataFrame, dims: dict, version: str) -> DataFrame:
    day = ["full_date", "year", "month_number"]
    center = ["station_code", "station_name", "station_region"]
    return (
        reduced.join(view(dims["dc"], "dc_key", "station_code", version).select("dc_key", *center), "dc_key")
        .join(dims["product_type"].select("product_type_key", "product_type_name"), "product_type_key")
        .groupBy(*day, *center, "product_type_name")
        .agg(
            F.sum("_s_units_sold").alias("total_units_sold"),
            F.sum("_s_returns_qty").alias("total_returns"),
            F.sum("_s_net_units").alias("net_units"),
            total("revenue_gbp").alias("total_revenue_gbp"),
            total("gross_profit_gbp").alias("total_profit_gbp"),
            *[average(c).alias(name) for c, name in _DAILY_AVERAGES.items()],
        )
    )


def _author_states(fact: DataFrame, dims: dict) -> DataFrame:
    quarter = ["year", "quarter_number", "quarter_name"]
    return partial(
        with_days(fact, dims["time"], quarter),
        [*quarter, "author_key", "product_key", "dc_key"],
        ["quantity_sold", "net_amount_gbp", "total_cost_gbp", "gross_profit_gbp"],
        ["gross_margin_pct"],
    )


def _author_shown(reduced: DataFrame, dims: dict, version: str) -> DataFrame:
    quarter = ["year", "quarter_number", "quarter_name"]
    author = view(dims["author"], "author_key", "author_id", version).select(
        "author_key", "author_id", F.col("full_name").alias("author_name"), "primary_genre"
    )
    product = view(dims["product"], "product_key", "edition_id", version)
    center = view(dims["dc"], "dc_key", "station_code", version)
    return (
        reduced.join(product.select("product_key", "edition_id"), "product_key")
        .join(author, "author_key")
        .join(center.select("dc_key", "station_region"), "dc_key")
        .groupBy(*quarter, "author_id", "author_name", "primary_genre", "station_region")
        .agg(
            n_rows().alias("transaction_count"),
            total("quantity_sold").alias("total_quantity"),
            total("net_amount_gbp").alias("total_revenue_gbp"),
            total("total_cost_gbp").alias("total_cost_gbp"),
            total("gross_profit_gbp").alias("total_profit_gbp"),
            average("gross_margin_pct").alias("avg_margin_pct"),
            F.count_distinct("edition_id").alias("_editions"),
        )
        .withColumn("revenue_per_edition", n.ratio(F.col("total_revenue_gbp"), F.col("_editions")))
        .drop("_editions")
    )


def vendor_cost_analysis(fact: DataFrame, dims: dict, version: str = "as_recorded") -> DataFrame:
    """Quarter x vendor: print runs, binding cost and its spread."""
    quarter = ["year", "quarter_number"]
    cost = F.col("unit_binding_cost")
    reduced = with_days(fact, dims["time"], quarter).groupBy(*quarter, "vendor_key").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("print_run_qty").alias("_s_print_run_qty"),
        F.sum("binding_cost_gbp").alias("_s_binding_cost_gbp"),
        F.sum(cost).alias("_s_unit_binding_cost"),
        F.count(cost).alias("_c_unit_binding_cost"),
        F.sum("vendor_score").alias("_s_vendor_score"),
        F.count("vendor_score").alias("_c_vendor_score"),
        F.var_pop(cost.cast("double")).alias("_var"),
    )
    vendor = view(dims["vendor"], "vendor_key", "vendor_id", version)
    shown = [*quarter, "vendor_id", "vendor_name"]
    named = reduced.join(vendor.select("vendor_key", "vendor_id", "vendor_name"), "vendor_key")
    # Merge the spread of several versions of one vendor: within plus between, around the
    # common mean. A vendor has few versions, so this window is tiny.
    together = Window.partitionBy(*shown)
    centre = n.ratio(
        F.sum("_s_unit_binding_cost").over(together), F.sum("_c_unit_binding_cost").over(together)
    )
    count = F.col("_c_unit_binding_cost")
    own = n.ratio(F.col("_s_unit_binding_cost"), count)
    spread = count * (F.col("_var") + (own - centre) * (own - centre))
    rolled = named.withColumn("_spread", spread).groupBy(*shown).agg(
        n_rows().alias("operation_days"),
        F.sum("_s_print_run_qty").alias("total_print_run"),
        total("binding_cost_gbp").alias("total_binding_cost"),
        average("unit_binding_cost").alias("avg_unit_cost"),
        average("vendor_score").alias("avg_vendor_score"),
        F.sum("_spread").alias("_spread"),
        F.sum("_c_unit_binding_cost").alias("_count"),
    )
    deviation = F.when(F.col("_count") == 1, F.lit(0.0)).otherwise(
        F.sqrt(n.ratio(F.col("_spread"), F.col("_count") - 1))
    )
    return (
        rolled.withColumn("cost_stddev", deviation)
        .withColumn("cost_variance_pct", n.ratio(F.col("cost_stddev"), F.col("avg_unit_cost")) * 100)
        .drop("_spread", "_count")
    )


def _vendor_states(fact: DataFrame, dims: dict) -> DataFrame:
    """As `vendor_cost_analysis` reads them, but with an exact sum of squares, which adds up over batches."""
    rows = with_days(fact, dims["time"], ["year", "quarter_number"])
    cost = F.col("unit_binding_cost").cast("decimal(12,4)")
    rows = rows.withColumn("squared_cost", (cost * cost).cast("decimal(24,8)"))
    return partial(
        rows, ["year", "quarter_number", "vendor_key"], ["print_run_qty", "binding_cost_gbp", "squared_cost"], ["unit_binding_cost", "vendor_score"]
    )


def _vendor_shown(reduced: DataFrame, dims: dict, version: str) -> DataFrame:
    vendor = view(dims["vendor"], "vendor_key", "vendor_id", version).select("vendor_key", "vendor_id", "vendor_name")
    rolled = reduced.join(vendor, "vendor_key").groupBy("year", "quarter_number", "vendor_id", "vendor_name").agg(
        n_rows().alias("operation_days"),
        F.sum("_s_print_run_qty").alias("total_print_run"),
        total("binding_cost_gbp").alias("total_binding_cost"),
        average("unit_binding_cost").alias("avg_unit_cost"),
        average("vendor_score").alias("avg_vendor_score"),
        F.sum("_s_squared_cost").cast("double").alias("_squares"),
        F.sum("_s_unit_binding_cost").cast("double").alias("_sum"),
        F.sum("_c_unit_binding_cost").alias("_count"),
    )
    spread = F.greatest(F.lit(0.0), F.col("_squares") - F.col("_sum") * n.ratio(F.col("_sum"), F.col("_count")))
    deviation = F.when(F.col("_count") == 1, F.lit(0.0)).otherwise(F.sqrt(n.ratio(spread, F.col("_count") - 1)))
    return (
        rolled.withColumn("cost_stddev", deviation)
        .withColumn("cost_variance_pct", n.ratio(F.col("cost_stddev"), F.col("avg_unit_cost")) * 100)
        .drop("_squares", "_sum", "_count")
    )


def _channel_states(fact: DataFrame, dims: dict) -> DataFrame:
    month = ["year", "month_number"]
    return partial(
        with_days(fact, dims["time"], month),
        [*month, "channel_key", "product_type_key"],
        ["quantity_sold", "gross_amount_gbp", "discount_amount_gbp", "net_amount_gbp", "gross_profit_gbp"],
        ["gross_margin_pct", "discount_rate"],
    )


def _channel_shown(reduced: DataFrame, dims: dict, version: str) -> DataFrame:
    month = ["year", "month_number"]
    channel = ["channel_code", "channel_name", "channel_type"]
    return (
        reduced.join(dims["channel"].select("channel_key", *channel), "channel_key")
        .join(dims["product_type"].select("product_type_key", "product_type_name"), "product_type_key")
        .groupBy(*month, *channel, "product_type_name")
        .agg(
            n_rows().alias("transaction_count"),
            total("quantity_sold").alias("total_quantity"),
            total("gross_amount_gbp").alias("gross_revenue_gbp"),
            total("discount_amount_gbp").alias("total_discount_gbp"),
            total("net_amount_gbp").alias("net_revenue_gbp"),
            total("gross_profit_gbp").alias("total_profit_gbp"),
            average("gross_margin_pct").alias("avg_margin_pct"),
            average("discount_rate").alias("avg_discount_rate"),
        )
        .withColumn("avg_transaction_value", n.ratio(F.col("net_revenue_gbp"), F.col("transaction_count")))
    )


def monthly_sales_summary(fact: DataFrame, dims: dict, version: str = "as_recorded") -> DataFrame:
    """Month x edition x channel x product type."""
    return _monthly_shown(_monthly_states(fact, dims), dims, version)


def daily_dc_performance(fact: DataFrame, dims: dict, version: str = "as_recorded") -> DataFrame:
    """Day x distribution center x product type, over the daily operations fact."""
    return _daily_shown(_daily_states(fact, dims), dims, version)


def quarterly_author_profit(fact: DataFrame, dims: dict, version: str = "as_recorded") -> DataFrame:
    """Quarter x author x region."""
    return _author_shown(_author_states(fact, dims), dims, version)


def channel_performance(fact: DataFrame, dims: dict, version: str = "as_recorded") -> DataFrame:
    """Month x channel x product type. Both dimensions carry no history; ``version`` has no effect."""
    return _channel_shown(_channel_states(fact, dims), dims, version)


# rollup name -> (fact it reads, builder)
ROLLUPS: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "monthly_sales_summary": ("fact_sales", monthly_sales_summary),
    "daily_dc_performance": ("fact_daily", daily_dc_performance),
    "quarterly_author_profit": ("fact_sales", quarterly_author_profit),
    "vendor_cost_analysis": ("fact_daily", vendor_cost_analysis),
    "channel_performance": ("fact_sales", channel_performance),
}


# --- refresh by deltas

#: Rollup name -> (states of some fact rows, rollup of states). States are sums and counts by calendar
#: columns and surrogate keys: those of two sets of rows add up, and no attribute of a dimension is in them.
STATES: dict[str, tuple[Callable[..., DataFrame], Callable[..., DataFrame]]] = {
    "monthly_sales_summary": (_monthly_states, _monthly_shown),
    "daily_dc_performance": (_daily_states, _daily_shown),
    "quarterly_author_profit": (_author_states, _author_shown),
    "vendor_cost_analysis": (_vendor_states, _vendor_shown),
    "channel_performance": (_channel_states, _channel_shown),
}
#: So many portions of states are read one by one before they are added up.
PORTIONS = 8


class RollupStates:
    """Stored states of one rollup, a portion per fact batch; read together they stand for all batches.

    A refresh reads the fact rows of new batches only, whatever changed in the dimensions: states hold
    surrogate keys, so a changed dimension is seen when they are shown. A repeated portion replaces its
    folder. Portions are added up into one (``upto=N``) once there are more than ``PORTIONS``.
    """

    def __init__(self, warehouse: Warehouse, name: str):
        self.warehouse, self.name, self.path = warehouse, name, f"state/{name}"
        self.make, self.show = STATES[name]

    def add(self, batch: int, rows: DataFrame, dims: dict) -> None:
        """Take a batch's fact rows in."""
        self.make(rows, dims).write.mode("overwrite").parquet(self.warehouse.path(f"{self.path}/batch={batch}"))

    def read(self, batches: list[int]) -> DataFrame | None:
        """The states of some batches, among them all that were added up."""
        top = self._upto()
        parts = [f"upto={top}"] if top else []
        parts += [f"batch={b}" for b in sorted(batches) if b > top]
        frames = [self.warehouse.read(f"{self.path}/{part}") for part in parts]
        return reduce(DataFrame.unionByName, frames) if frames else None

    def _upto(self) -> int:
        done = self.warehouse.read(f"{self.path}/compacted", schema_of("upto bigint"))
        return done.agg(F.max("upto")).first()[0] or 0

    def compact(self, batches: list[int]) -> None:
        """Add portions up if there are many; the batches must all be whole."""
        top = self._upto()
        fresh = [b for b in batches if b > top]
        if len(fresh) <= PORTIONS:
            return
        states = self.read(batches)
        keys = [c for c in states.columns if not c.startswith("_")]
        sums = [F.sum(c).cast(states.schema[c].dataType).alias(c) for c in states.columns if c.startswith("_")]
        last = max(fresh)
        states.groupBy(*keys).agg(*sums).write.mode("overwrite").parquet(self.warehouse.path(f"{self.path}/upto={last}"))
        self.warehouse.append(f"{self.path}/compacted", few_rows(self.warehouse.spark, [(last,)], schema_of("upto bigint")))
        for gone in [*[f"batch={b}" for b in fresh], *([f"upto={top}"] if top else [])]:
            discard(self.warehouse.spark, self.warehouse.path(f"{self.path}/{gone}"))


def refresh_from_states(
    warehouse: Warehouse, name: str, states: DataFrame, dims: dict, version: str = "as_recorded", years: list[int] | None = None
) -> DataFrame:
    """Replace a stored rollup by what its states show; of some years only, if no dimension changed since."""
    old = warehouse.current(f"rollup/{name}")
    if years is None or old is None:
        return refresh(warehouse, name, STATES[name][1](states, dims, version))
    if not years:
        return old
    made = STATES[name][1](states.filter(F.col("year").isin(*years)), dims, version)
    return refresh(warehouse, name, old.filter(~F.col("year").isin(*years)).unionByName(made))


def refresh(warehouse: Warehouse, name: str, df: DataFrame) -> DataFrame:
    """Replace a stored rollup completely and read it back; readers switch when it is whole."""
    warehouse.replace(f"rollup/{name}", df)
    return warehouse.current(f"rollup/{name}")


def refresh_touched(
    warehouse: Warehouse, name: str, fact: DataFrame, build: Callable[[DataFrame], DataFrame], years: list[int]
) -> DataFrame:
    """Recompute the given years of a stored rollup; the others are taken over from its last version."""
    if not years:
        return warehouse.current(f"rollup/{name}")
    months = F.col("year_month").between(min(years) * 100, max(years) * 100 + 99) if "year_month" in fact.columns else F.lit(True)
    part = fact.filter(months & F.floor(F.col("time_key") / 10000).cast("int").isin(*years))
    kept = warehouse.current(f"rollup/{name}").filter(~F.col("year").isin(*years))
    return refresh(warehouse, name, kept.unionByName(build(part)))


def refresh_years(df: DataFrame, path: str, years: list[int]) -> None:
    """Replace only the given years of a rollup stored by year."""
    (
        df.filter(F.col("year").isin(*years))
        .hint("rebalance", F.col("year"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year")
        .parquet(path)
    )
