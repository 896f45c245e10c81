"""Fact builds: lookups, measures rounded step by step, reject reasons, first-wins keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliomart.functions import numeric as n
from foliomart.operators import quality as q
from foliomart.operators.keys import MOST_PIECES, PIECE_ROWS, assign_keys, later_rows
from foliomart.operators.lookups import Star, ambiguous, current, looked_up, unique_by
from foliomart.schemas import (
    DEFAULT_RATES,
    FACT_DAILY,
    FACT_SALES,
    FIRST_FACT_KEY,
    UNKNOWN_KEY,
)
from foliomart.session import release, saved, scratch_path
from foliomart.sources.staging import ready


def type_name_key(name: Column) -> Column:
    """Product types match without regard to case, and U+2011 counts as a plain hyphen."""
    return F.upper(F.translate(name, "‑", "-"))


def first_failure(cases: list[tuple[Column, str]]) -> Column:
    """The reason of the first condition that holds, null if none does.

    Written over an array rather than as one long chain: a chain of this many branches inlines
    into a method too large for the JVM to compile.
    """
    found = F.filter(F.array(*[F.when(c, F.lit(r)) for c, r in cases]), lambda r: r.isNotNull())
    return F.get(found, F.lit(0))


class _Measures:
    """Columns that round into their type level by level, noting what did not fit."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.overflows: list[tuple[Column, str]] = []

    def operands(self, *columns: str) -> None:
        """Narrow staged numbers for exact arithmetic; larger ones would fit no measure either."""
        self.df = self.df.withColumns({f"_large_{c}": n.overflowed(F.col(c), n.OPERAND) for c in columns})
        self.df = self.df.withColumns({c: n.fit(F.col(c), n.OPERAND) for c in columns})
        self.overflows += [(F.col(f"_large_{c}"), f"OVERFLOW_{c.upper()}") for c in columns]

    def level(self, **values: tuple[Column, str]) -> None:
        """Add columns that depend only on earlier levels.

        A value is a column before it is fitted and noted, so the arithmetic runs once per row and
        the reasons are told from flags.
        """
        self.df = self.df.withColumns({f"_raw_{name}": v for name, (v, _) in values.items()})
        self.df = self.df.withColumns({name: n.fit(F.col(f"_raw_{name}"), dtype) for name, (_, dtype) in values.items()})
        lost = {f"_lost_{name}": F.col(name).isNull() & F.col(f"_raw_{name}").isNotNull() for name in values}
        self.df = self.df.withColumns(lost).drop(*[f"_raw_{name}" for name in values])
        self.overflows += [(F.col(f"_lost_{name}"), f"OVERFLOW_{name.upper()}") for name in values]


def _broken(checks: dict[str, str]) -> list[tuple[Column, str]]:
    return [(~n.holds(F.expr(sql)), name.upper()) for name, sql in checks.items()]


def _lookup(
    rows: DataFrame, star: Star, dim: str, found: DataFrame, name: str, on: Column, work: str
) -> DataFrame:
    return rows.join(star.sized(dim, found, work), on == F.col(f"_{name}_on"), "left")


def _time(rows: DataFrame, star: Star) -> DataFrame:
    days = star.sized("time", star["time"].select(F.col("full_date").alias("_full_date"), "time_key"))
    return rows.join(days, F.col("date_parsed") == F.col("_full_date"), "left")


def exchange_rate(
    rows: DataFrame,
    star: Star,
    rates: DataFrame | None,
    currency: str = "curr",
    defaults: dict[str, str] = DEFAULT_RATES,
) -> DataFrame:
    """Add ``exchange_rate`` into the base currency by (``currency_key``, ``time_key``).

    Without a dated rate the default of the currency applies, else 1.
    """
    fallback = F.lit("1").cast(n.RATE)
    for code, rate in defaults.items():
        fallback = F.when(F.col(currency) == code, F.lit(rate).cast(n.RATE)).otherwise(fallback)
    if rates is None:
        return rows.withColumn("exchange_rate", fallback)
    base = star["currency"].filter(F.col("is_base_currency") == "Y").agg(F.min("currency_key"))
    dated = (
        rates.filter(F.col("to_currency_key") == base.scalar())
        .groupBy(F.col("from_currency_key").alias("currency_key"), "time_key")
        .agg(F.min("exchange_rate").alias("_dated"))
    )
    return (
        rows.join(dated, ["currency_key", "time_key"], "left")
        .withColumn("exchange_rate", F.coalesce("_dated", fallback))
        .drop("_dated")
    )


def _profit() -> dict[str, tuple[Column, str]]:
    """Measures that follow from stored ones of the same sale, in the order they build on each other."""
    margin = n.guarded(F.col("gross_profit_gbp") * 100, F.col("net_amount_gbp"))
    return {
        "net_amount_gbp": (F.col("gross_amount_gbp") - F.col("discount_amount_gbp"), n.MONEY),
        "gross_profit_gbp": (F.col("net_amount_gbp") - F.col("total_cost_gbp"), n.MONEY),
        "gross_margin_pct": (margin, n.PERCENT),
    }


def _sales_tagged(
    staged: DataFrame, star: Star, rates: DataFrame | None, unknown: str, dc_map: DataFrame | None, work: str
) -> DataFrame:
    rows = _time(ready(staged), star)

    product = unique_by(
        current(star["product"]).filter(F.col("product_key") != UNKNOWN_KEY),
        F.col("edition_id"),
        ["product_key", "author_key", "vendor_key"],
        "product",
    )
    channel = unique_by(star["channel"], F.col("channel_code"), ["channel_key"], "channel")
    kind = unique_by(
        star["product_type"], F.upper("product_type_name"), ["product_type_key"], "kind"
    )
    money = unique_by(star["currency"], F.col("currency_code"), ["currency_key"], "money")
    rows = _lookup(rows, star, "product", product, "product", F.col("ed_id"), work)
    rows = _lookup(rows, star, "channel", channel, "channel", F.col("chnl"), work)
    rows = _lookup(rows, star, "product_type", kind, "kind", type_name_key(F.col("typ")), work)
    rows = _lookup(rows, star, "currency", money, "money", F.col("curr"), work)

    centers = current(star["dc"]).filter(F.col("dc_key") != UNKNOWN_KEY)
    missing = F.lit(UNKNOWN_KEY).cast("bigint")
    if dc_map is None:
        # no source column names the center of a sale: all go to the first one
        dc_key = centers.agg(F.min("dc_key")).scalar()
    else:
        on = next(c for c in dc_map.columns if c != "station_code")
        mapped = dc_map.join(centers.select("station_code", "dc_key"), "station_code")
        # written, so that a map of any size is a plain side of the join
        by_column = saved(unique_by(mapped, F.col(on), ["dc_key"], "center"), f"{work}/centers")
        rows = rows.join(by_column, F.col(on) == F.col("_center_on"), "left")
        dc_key = looked_up("center", "dc_key")
    rows = rows.withColumns(
        {
            "product_key": F.coalesce(looked_up("product", "product_key"), missing),
            "author_key": F.coalesce(looked_up("product", "author_key"), missing),
            "vendor_key": F.coalesce(looked_up("product", "vendor_key"), missing),
            "channel_key": F.coalesce(looked_up("channel", "channel_key"), missing),
            "product_type_key": F.coalesce(looked_up("kind", "product_type_key"), missing),
            "currency_key": F.coalesce(looked_up("money", "currency_key"), missing),
            "dc_key": F.coalesce(dc_key, missing),
        }
    )
    rows = exchange_rate(rows, star, rates)

    m = _Measures(rows)
    m.operands("tqty", "uprice", "dscnt", "discount_imputed", "pd", "bc", "vscr")
    discount = F.coalesce("dscnt", "discount_imputed")
    m.level(
        quantity_sold=(F.col("tqty"), n.QUANTITY),
        unit_price_original=(F.col("uprice"), n.MONEY),
        unit_price_gbp=(F.col("uprice") * F.col("exchange_rate"), n.MONEY),
        discount_rate=(discount, n.DISCOUNT),
        print_run_qty=(F.col("pd"), "decimal(10,0)"),
        binding_cost_gbp=(F.col("bc"), n.MONEY),
        unit_cost_gbp=(n.guarded(F.col("bc"), F.col("pd")), n.MONEY),
        vendor_score=(F.col("vscr"), n.SCORE),
    )
    m.level(
        gross_amount_gbp=(F.col("unit_price_gbp") * F.col("tqty"), n.MONEY),
        total_cost_gbp=(F.col("unit_cost_gbp") * F.col("tqty"), n.MONEY),
    )
    applied = F.coalesce(discount, F.lit(0).cast(n.OPERAND))
    m.level(discount_amount_gbp=(F.col("gross_amount_gbp") * applied, n.MONEY))
    for name, measure in _profit().items():
        m.level(**{name: measure})
    rows = m.df.withColumn("sale_number", F.col("sale_num"))

    reasons = [(F.col("time_key").isNull(), "NO_TIME_KEY")]
    reasons += [
        (ambiguous(name), f"AMBIGUOUS_{label}")
        for name, label in [
            ("product", "PRODUCT"), ("channel", "CHANNEL"), ("kind", "PRODUCT_TYPE"), ("money", "CURRENCY")
        ]
    ]
    if dc_map is not None:
        reasons.append((ambiguous("center"), "AMBIGUOUS_DC"))
    if unknown == "reject":
        reasons += [
            (F.col(f"{dim}_key") == UNKNOWN_KEY, f"UNKNOWN_{dim.upper()}")
            for dim in ("product", "author", "vendor", "dc", "channel", "product_type", "currency")
        ]
    elif unknown != "member":
        raise ValueError(f"unknown must be 'member' or 'reject', not {unknown!r}")
    reasons += m.overflows + _broken(q.not_null_checks(q.SALES_MANDATORY)) + _broken(q.SALES_CHECKS)
    return rows.withColumn("reject_reason", first_failure(reasons))


def _finish(
    tagged: DataFrame,
    staged: DataFrame,
    schema: T.StructType,
    key: str,
    unique: list[str],
    id_col: str,
    source: str,
    batch_id: int,
    existing: DataFrame | None,
    first_key: int | None,
    work: str,
    follow: dict[str, tuple[Column, str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """First valid row per unique key becomes a fact row; every other row a reject.

    Measures that ``follow`` from others are not carried along but worked out again for the accepted rows.
    """
    follow = follow or {}
    audit = {
        "source_system": F.lit(source),
        "source_record_id": F.col(id_col).cast("string"),
        "load_date": F.current_timestamp(),
        "load_batch_id": F.lit(batch_id),
        "created_date": F.current_timestamp(),
        "created_by": F.current_user(),
    }
    measures = [f.name for f in schema.fields if f.name not in {*audit, key, *follow}]
    # Lookups and arithmetic run once: the split below reads this narrow table several times.
    carried = list(dict.fromkeys([id_col, "date_parsed", *measures]))
    tagged = saved(tagged.select(*carried, "reject_reason"), f"{work}/tagged")
    release(staged.sparkSession)
    valid = tagged.filter(F.col("reject_reason").isNull())
    if first_key is not None:
        start = F.lit(first_key)
    elif existing is not None:
        start = existing.agg(F.coalesce(F.max(key) + 1, F.lit(FIRST_FACT_KEY))).scalar()
    else:
        start = F.lit(FIRST_FACT_KEY)
    late = later_rows(valid, unique, ["date_parsed", id_col], work, existing)
    # counted from the written rows, as an upper bound of those kept
    pieces = min(max(1, -(-tagged.count() // PIECE_ROWS)), MOST_PIECES)
    release(staged.sparkSession)
    numbered = assign_keys(valid.select(*carried), "date_parsed", id_col, key, start, pieces, f"{work}/kept", late)
    release(staged.sparkSession)
    for name, (value, dtype) in follow.items():
        numbered = numbered.withColumn(name, n.fit(value, dtype))
    refused = tagged.filter(F.col("reject_reason").isNotNull()).select(id_col, "reject_reason")
    refused = refused.unionByName(late.select(id_col, F.lit("DUPLICATE").alias("reject_reason")))
    rejected = staged.join(refused, id_col).select(*staged.columns, "reject_reason")
    values = {f.name: F.col(f.name) for f in schema.fields if f.name not in audit} | audit
    fact = numbered.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return fact, rejected


def build_fact_sales(
    staged: DataFrame,
    star: Star,
    batch_id: int,
    rates: DataFrame | None = None,
    unknown: str = "member",
    dc_map: DataFrame | None = None,
    existing: DataFrame | None = None,
    first_key: int | None = None,
    work: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Sales fact and rejected staging rows with their reason.

    ``unknown="member"`` keeps rows without a dimension match under key -1, ``"reject"`` refuses
    them. ``dc_map`` (one staged column, ``station_code``) names the center of a sale; without it
    all sales go to the first current center. Rows whose sale number ``existing`` holds are
    rejected, and keys continue after its highest.

    The looked-up rows and the accepted ones are written to ``work`` (a folder the executors
    share) on the way, so lookups and arithmetic run once.
    """
    work = work or scratch_path(staged.sparkSession, "fact-sales")
    tagged = _sales_tagged(staged, star, rates, unknown, dc_map, work)
    return _finish(
        tagged, staged, FACT_SALES, "sales_fact_key", ["sale_number"], "stg_sales_id",
        "RAW_SALES", batch_id, existing, first_key, work, _profit(),
    )


def _daily_tagged(staged: DataFrame, star: Star, work: str) -> DataFrame:
    rows = _time(ready(staged), star)
    # station -> center and vendor; the bridge ties a station to its vendor
    centers = current(star["dc"]).select("station_code", "dc_key")
    vendors = current(star["vendor"]).select("vendor_id", "vendor_key")
    station = unique_by(
        centers.join(star["station_vendor"], "station_code").join(vendors, "vendor_id"),
        F.col("station_code"),
        ["dc_key", "vendor_key"],
        "station",
    )
    kind = unique_by(
        star["product_type"].filter(F.col("product_type_key") != UNKNOWN_KEY),
        F.upper("product_type_name"),
        ["product_type_key"],
        "kind",
    )
    products = current(star["product"]).filter(F.col("product_key") != UNKNOWN_KEY)
    # at most one row per bridge row
    rows = _lookup(rows, star, "station_vendor", station, "station", F.col("stn_code"), work)
    rows = _lookup(rows, star, "product_type", kind, "kind", type_name_key(F.col("typ")), work)
    rows = rows.withColumns(
        {
            "dc_key": looked_up("station", "dc_key"),
            "vendor_key": looked_up("station", "vendor_key"),
            "product_type_key": looked_up("kind", "product_type_key"),
            # daily rows name no edition: all get the first current product
            "product_key": products.agg(F.min("product_key")).scalar(),
        }
    )
    m = _Measures(rows)
    m.operands("pd", "bc", "us", "rv", "rev", "tmp", "hmd", "vscr")
    returns = F.coalesce(F.col("rv"), F.lit(0).cast(n.OPERAND))
    whole = "decimal(10,0)"
    m.level(
        print_run_qty=(F.col("pd"), whole),
        binding_cost_gbp=(F.col("bc"), n.MONEY),
        units_sold=(F.col("us"), whole),
        returns_qty=(returns, whole),
        net_units=(F.col("us") - returns, whole),
        revenue_gbp=(F.col("rev"), n.MONEY),
        unit_binding_cost=(n.guarded(F.col("bc"), F.col("pd")), n.UNIT_COST),
        print_run_utilization=(n.guarded(F.col("us") * 100, F.col("pd")), n.PERCENT),
        return_rate_pct=(n.guarded(returns * 100, F.col("us")), n.PERCENT),
        temperature_celsius=(F.col("tmp"), n.TEMPERATURE),
        humidity_pct=(F.col("hmd"), "decimal(3,0)"),
        vendor_score=(F.col("vscr"), n.SCORE),
    )
    m.level(cost_of_goods_sold=(F.col("unit_binding_cost") * F.col("us"), n.MONEY))
    m.level(gross_profit_gbp=(F.col("rev") - F.col("cost_of_goods_sold"), n.MONEY))
    margin = n.guarded(F.col("gross_profit_gbp") * 100, F.col("rev"))
    m.level(gross_margin_pct=(margin, n.PERCENT))
    reasons = [
        (F.col("time_key").isNull(), "NO_TIME_KEY"),
        (ambiguous("station"), "AMBIGUOUS_STATION"),
        (F.col("dc_key").isNull(), "NO_DC"),
        (ambiguous("kind"), "AMBIGUOUS_PRODUCT_TYPE"),
        (F.col("product_type_key").isNull(), "NO_PRODUCT_TYPE"),
        (F.col("product_key").isNull(), "NO_PRODUCT"),
    ]
    reasons += m.overflows + _broken(q.not_null_checks(q.DAILY_MANDATORY)) + _broken(q.DAILY_CHECKS)
    return m.df.withColumn("reject_reason", first_failure(reasons))


def build_fact_daily(
    staged: DataFrame,
    star: Star,
    batch_id: int,
    existing: DataFrame | None = None,
    first_key: int | None = None,
    work: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Daily operations fact and rejected staging rows; any missed lookup rejects.

    The star needs ``station_vendor`` (station_code, vendor_id) beside the dimensions.
    """
    work = work or scratch_path(staged.sparkSession, "fact-daily")
    tagged = _daily_tagged(staged, star, work)
    return _finish(
        tagged, staged, FACT_DAILY, "daily_ops_fact_key",
        ["time_key", "dc_key", "product_type_key"], "stg_daily_id",
        "RAW_DAILY", batch_id, existing, first_key, work,
    )


def load_summary(fact: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows per outcome: LOADED, or the reject reason."""
    loaded = fact.groupBy(F.lit("LOADED").alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))
    failed = rejected.groupBy(F.col("reject_reason").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return loaded.unionByName(failed)
