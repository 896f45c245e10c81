"""Statistics on top of the rollups: correlation, outliers, forecast, ranks, cost trend, segments."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomart.functions import numeric as n
from foliomart.plans.queries import dc_ranking
from foliomart.plans.rollups import partial, total, vendor_cost_analysis, with_days
from foliomart.schemas import UNKNOWN_KEY
from foliomart.session import saved, scratch_path

# A value range is cut into this many parts per round, until it holds few enough rows to sort.
PARTS = 1024
FEW_ROWS = 100_000
# Standardised features are whole numbers of this fraction of a deviation, so that sums are exact.
GRID = 1_000_000


def correlations(fact: DataFrame, by: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of column pairs per group, one row per group and pair."""
    made = fact.groupBy(by).agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}")
          for i, (a, b) in enumerate(pairs)]
    )
    rows = [
        F.struct(F.lit(a).alias("left_measure"), F.lit(b).alias("right_measure"), F.col(f"_{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return made.select(by, F.inline(F.array(*rows)))


def outliers(
    fact: DataFrame, by: str, measure: str, method: str = "zscore", limit: float = 3.0
) -> DataFrame:
    """Rows far from their group: beyond ``limit`` deviations, or ``limit`` quartile ranges outside.

    The group figures are one row per group, written, so that their size is known before the rows are joined to
    them: small ones are broadcast and the fact is not shuffled.
    """
    x = F.col(measure).cast("double")
    if method == "zscore":
        figures = fact.groupBy(by).agg(
            n.mean(F.col(measure)).alias("_centre"), n.stddev_one_is_zero(x).alias("_spread")
        )
        score = (x - F.col("_centre")) / F.nullif(F.col("_spread"), F.lit(0.0))
        far = F.abs(F.col("score")) > limit
    elif method == "iqr":
        figures = quartiles(fact, by, measure)
        width = F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0))
        score = F.greatest(F.col("_low") - x, x - F.col("_high")) / width
        far = F.col("score") > limit
    else:
        raise ValueError(f"unknown method {method!r}")
    figures = saved(figures, scratch_path(fact.sparkSession, "figures"))
    return fact.join(figures, by).withColumn("score", score).filter(far).select(*fact.columns, "score")


def quantiles(df: DataFrame, by: str, measure: str, shares: list[float], work: str | None = None) -> DataFrame:
    """Discrete quantiles per group, exactly: ``by``, ``share``, ``value`` (double).

    Each group and share has a range of values that holds its quantile, and the quantile's rank in
    it. A range of more than ``FEW_ROWS`` rows is cut into ``PARTS`` equal parts, rows are counted
    per part (map-side sums), and the part that holds the rank, shrunk to its least and largest
    value, is the next range. Only the rows of a small range are sorted, so a hot group with any
    number of different values stays spread over tasks. Ranges are written between rounds; a
    round settles about ten binary digits of the values.

    Null, infinite and NaN values take no part; a group without others has no row, and neither has
    the null group.
    """
    work = work or scratch_path(df.sparkSession, "quantiles")
    x, lo, hi = F.col("_x"), F.col("_lo"), F.col("_hi")
    values = df.select(by, F.col(measure).cast("double").alias("_x")).filter(
        (F.abs("_x") < float("inf")) & F.col(by).isNotNull()
    )
    held = [F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")]
    rank = F.greatest(F.ceil(F.col("_n") * F.col("share")).cast("bigint"), F.lit(1).cast("bigint"))
    ranges = values.groupBy(by).agg(*held).withColumn("share", F.explode(F.array(*map(F.lit, shares))))
    ranges = ranges.select(by, "share", rank.alias("_rank"), "_n", "_lo", "_hi")
    wide = (lo < hi) & (F.col("_n") > FEW_ROWS)
    in_order = Window.partitionBy(by, "share")

    def inside(some: DataFrame) -> DataFrame:
        return values.join(some.drop("_n"), by).filter(x.between(lo, hi))

    def at_rank(counted: DataFrame, place: str) -> DataFrame:
        """Of counts in order of ``place``, the row that holds the rank; ``_rank`` is then counted inside it."""
        upto = F.sum("_n").over(in_order.orderBy(place).rowsBetween(Window.unboundedPreceding, 0))
        before = F.col("_upto") - F.col("_n")
        found = counted.withColumn("_upto", upto).filter((F.col("_upto") >= F.col("_rank")) & (before < F.col("_rank")))
        return found.withColumn("_rank", F.col("_rank") - before)

    turn = 0
    while True:
        ranges = saved(ranges, f"{work}/ranges-{turn}")
        if ranges.filter(wide).isEmpty():
            break
        half = F.when(hi / 2 - lo / 2 > 1e300, 0.5).otherwise(1.0)  # no overflow
        place = (x * half - lo * half) / (hi * half - lo * half)
        part = F.least(F.floor(place * PARTS), F.lit(PARTS - 1).cast("bigint")).alias("_part")
        counted = inside(ranges.filter(wide)).groupBy(by, "share", "_rank", part).agg(*held)
        ranges = ranges.filter(~wide).unionByName(at_rank(counted, "_part").select(*ranges.columns))
        turn += 1
    counted = inside(ranges.filter(lo < hi)).groupBy(by, "share", "_rank", "_x").agg(F.count(F.lit(1)).alias("_n"))
    sorted_out = at_rank(counted, "_x").select(by, "share", x.alias("value"))
    return ranges.filter(lo == hi).select(by, "share", lo.alias("value")).unionByName(sorted_out)


def quartiles(fact: DataFrame, by: str, measure: str) -> DataFrame:
    """The discrete first and third quartile per group, exactly."""
    found = quantiles(fact, by, measure, [0.25, 0.75])

    def at(share: float, name: str) -> Column:
        return F.max(F.when(F.col("share") == share, F.col("value"))).alias(name)

    return found.groupBy(by).agg(at(0.25, "_low"), at(0.75, "_high"))


def quarterly_revenue(fact: DataFrame, dims: dict) -> DataFrame:
    """Revenue per product type and quarter, with a running quarter number."""
    period = ["year", "quarter_number"]
    reduced = partial(
        with_days(fact, dims["time"], period), [*period, "product_type_key"], ["net_amount_gbp"], []
    )
    return (
        reduced.join(dims["product_type"].select("product_type_key", "product_type_name"), "product_type_key")
        .groupBy("product_type_name", *period)
        .agg(total("net_amount_gbp").alias("revenue"))
        .withColumn("quarter_index", F.col("year") * 4 + F.col("quarter_number") - 1)
    )


def trend_forecast(fact: DataFrame, dims: dict) -> DataFrame:
    """Straight-line revenue forecast for the next quarter of each product type."""
    y, x = F.col("revenue").cast("double"), F.col("quarter_index").cast("double")
    fitted = quarterly_revenue(fact, dims).groupBy("product_type_name").agg(
        F.count(F.lit(1)).alias("quarters"),
        F.max("quarter_index").alias("_last"),
        F.regr_slope(y, x).alias("slope"),
        F.avg(x).alias("_mean_x"),
        F.avg(y).alias("_mean_y"),
    )
    upcoming = F.col("_last") + 1
    return fitted.select(
        "product_type_name",
        "quarters",
        F.floor(upcoming / 4).cast("int").alias("next_year"),
        (upcoming % 4 + 1).cast("int").alias("next_quarter"),
        "slope",
        (F.col("_mean_y") + F.col("slope") * (upcoming - F.col("_mean_x"))).alias("forecast"),
    )


def dc_percentile(fact: DataFrame, dims: dict, as_of: dt.date | dt.datetime, lowest: float = 0.2) -> DataFrame:
    """Centers by profit percentile; the lowest are candidates for consolidation."""
    ranked = dc_ranking(fact, dims, as_of)
    place = F.percent_rank().over(Window.orderBy(F.asc_nulls_first("total_profit")))
    return ranked.withColumn("profit_percentile", place).select(
        "station_code",
        "station_region",
        "total_profit",
        "profit_rank",
        "profit_percentile",
        (F.col("profit_percentile") <= lowest).alias("consolidation_candidate"),
    )


def vendor_trend(fact: DataFrame, dims: dict, version: str = "as_recorded") -> DataFrame:
    """Average unit cost per vendor and quarter against the quarter before.

    A vendor has one row per quarter here, so its window stays small.
    """
    rolled = vendor_cost_analysis(fact, dims, version)
    in_order = Window.partitionBy("vendor_id").orderBy("year", "quarter_number")
    before = F.lag("avg_unit_cost").over(in_order)
    return rolled.withColumn("prev_unit_cost", before).select(
        "vendor_id",
        "vendor_name",
        "year",
        "quarter_number",
        "avg_unit_cost",
        "prev_unit_cost",
        n.growth_pct(F.col("avg_unit_cost"), F.col("prev_unit_cost")).alias("unit_cost_growth_pct"),
    )


def author_features(fact: DataFrame, dims: dict) -> DataFrame:
    """What authors are grouped by: volume, revenue, profit, margin and discount."""
    author = dims["author"].filter(F.col("author_key") != UNKNOWN_KEY).select("author_key", "author_id")
    reduced = partial(
        fact, ["author_key"], ["quantity_sold", "net_amount_gbp", "gross_profit_gbp"],
        ["gross_margin_pct", "discount_rate"],
    )
    return reduced.join(author, "author_key").select(
        "author_id",
        F.col("_s_quantity_sold").cast("double").alias("units"),
        F.col("_s_net_amount_gbp").cast("double").alias("revenue"),
        F.col("_s_gross_profit_gbp").cast("double").alias("profit"),
        F.coalesce(n.ratio(F.col("_s_gross_margin_pct"), F.col("_c_gross_margin_pct")), F.lit(0.0)).alias("margin"),
        F.coalesce(n.ratio(F.col("_s_discount_rate"), F.col("_c_discount_rate")), F.lit(0.0)).alias("discount"),
    )


def _apart(names: list[str], centre: list[float]) -> Column:
    """Squared distance of a row to a centre."""
    return reduce(add, [(F.col(c) - F.lit(v)) * (F.col(c) - F.lit(v)) for c, v in zip(names, centre)])


def _nearest(names: list[str], centres: list[list[float]]) -> Column:
    """Number of the nearest centre, the smaller one of equally near ones."""
    apart = F.array(*[_apart(names, c) for c in centres])
    return (F.array_position(apart, F.array_min(apart)) - 1).cast("int")


def segments(features: DataFrame, k: int = 4, rounds: int = 20, work: str | None = None) -> DataFrame:
    """K-means segments over the standardised feature columns (all but the first, which names the row).

    The first centre is the row farthest from the mean, each further one the row farthest from the
    centres so far, the smaller id of equally far ones. Then Lloyd rounds: rows go to the nearest
    centre, centres to the mean of their rows (without rows they stay), until none moves or after
    ``rounds``. Standardised values are whole numbers of a millionth of a deviation, so sums are
    exact and any order of rows gives the same segments. A round is one aggregate with map-side
    sums over the written rows; only the k centres come to the driver. Null features count as the
    mean; segments are numbered from 0 in the order of the first centres.
    """
    spark, (id_col, *used) = features.sparkSession, features.columns
    names = [f"_z{i}" for i in range(len(used))]
    figures = features.agg(
        *[f(F.col(c).cast("double")).alias(f"_{n}{i}") for i, c in enumerate(used) for n, f in (("m", F.avg), ("d", F.stddev_samp))]
    )
    grid = [
        F.coalesce(F.round((F.col(c) - F.col(f"_m{i}")) / F.nullif(F.col(f"_d{i}"), F.lit(0.0)) * GRID), F.lit(0.0))
        for i, c in enumerate(used)
    ]
    # one row of figures
    rows = features.join(F.broadcast(figures)).select(*features.columns, *[g.cast("bigint").alias(n) for g, n in zip(grid, names)])
    rows = saved(rows, work or scratch_path(spark, "segments"))

    def farthest(apart: Column) -> list[float] | None:
        first = F.min_by(F.array(*names), F.struct(-apart, F.col(id_col)))
        found = rows.agg(first.alias("at")).first()["at"]
        return found and [float(v) for v in found]

    first = farthest(_apart(names, [0.0] * len(names)))
    if first is None:
        return rows.select(*features.columns, F.lit(None).cast("int").alias("segment"))
    centres = [first]
    while len(centres) < k:
        centres.append(farthest(F.array_min(F.array(*[_apart(names, c) for c in centres]))))
    for _ in range(rounds):
        means = rows.groupBy(_nearest(names, centres).alias("segment")).agg(
            *[(F.sum(c).cast("double") / F.count(F.lit(1))).alias(c) for c in names]
        )
        moved = {r["segment"]: [r[c] for c in names] for r in means.collect()}
        after = [moved.get(j, c) for j, c in enumerate(centres)]
        if after == centres:
            break
        centres = after
    return rows.select(*features.columns, _nearest(names, centres).alias("segment"))
