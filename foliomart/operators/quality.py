"""Quality rules, row verdicts, key checks and declared constraints."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomart.functions import numeric as n
from foliomart.functions.dates import parsed_date
from foliomart.schemas import QUALITY_LOG, SOURCE_COLUMNS


@dataclass(frozen=True)
class Rules:
    """What a source should look like; columns the frame lacks are skipped."""

    required: list[str] = field(default_factory=list)
    numeric: list[str] = field(default_factory=list)
    positive: list[str] = field(default_factory=list)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    dates: list[str] = field(default_factory=list)
    mandatory: list[str] = field(default_factory=list)

    def renamed(self, names: dict[str, str]) -> Rules:
        """The same rules under other column names."""

        def many(columns: list[str]) -> list[str]:
            return [names.get(c, c) for c in columns]

        return replace(
            self,
            required=many(self.required),
            numeric=many(self.numeric),
            positive=many(self.positive),
            ranges={names.get(c, c): v for c, v in self.ranges.items()},
            categories={names.get(c, c): v for c, v in self.categories.items()},
            dates=many(self.dates),
            mandatory=many(self.mandatory),
        )


# The two spellings of the third type differ in the hyphen (U+2011 or "-").
PRODUCT_TYPES = ["Hardcover", "Paperback", "e‑Book", "e-Book"]

RULES = {
    "raw_sales": Rules(
        required=["SaleNum", "DateStamp", "EdID", "Chnl", "TQty", "UPrice", "Curr", "PD", "BC", "Typ"],
        numeric=["TQty", "UPrice", "Dscnt", "PD", "BC", "VScr"],
        positive=["TQty", "UPrice", "PD", "BC"],
        ranges={"Dscnt": (0, 0.25), "VScr": (0, 10)},
        categories={
            "Chnl": ["CH001", "CH002", "CH003"],
            "Curr": ["GBP", "USD", "EUR"],
            "Typ": PRODUCT_TYPES,
        },
        dates=["DateStamp"],
        mandatory=["SaleNum", "TQty", "UPrice", "PD", "BC"],
    ),
    "raw_daily": Rules(
        required=["DateID", "StnCode", "PD", "BC", "US", "RV", "Rev", "Typ"],
        numeric=["PD", "BC", "US", "RV", "Rev", "Tmp", "Hmd", "VScr"],
        positive=["PD", "BC", "US", "RV", "Rev"],
        ranges={"Tmp": (-50, 60), "Hmd": (0, 100), "VScr": (0, 10)},
        categories={"StnCode": ["DC001", "DC002", "DC003"], "Typ": PRODUCT_TYPES},
        dates=["DateID"],
        mandatory=["StnCode", "PD", "BC", "US", "Rev"],
    ),
    "raw_meta": Rules(
        numeric=["vendor/score"],
        ranges={"vendor/score": (0, 10)},
        mandatory=["station/id", "vendor/id", "publication/ed", "author/id"],
    ),
}
STAGED_RULES = {source: rules.renamed(SOURCE_COLUMNS[source]) for source, rules in RULES.items()}


def _cell(name: str) -> Column:
    return F.col(f"`{name}`")


def _number(name: str) -> Column:
    return _cell(name).try_cast("double")


def _rule_columns(df: DataFrame, rules: Rules) -> list[tuple[str, str, Column, str]]:
    """(rule name, severity, condition marking a bad row, message after the count)."""
    have = set(df.columns)
    out = []
    for c in rules.numeric:
        out.append((f"numeric:{c}", "WARNING", _number(c).isNull(), "cells without a number"))
    for c in rules.positive:
        out.append((f"positive:{c}", "ERROR", _number(c) < 0, "values below zero"))
    for c, (low, high) in rules.ranges.items():
        bad = (_number(c) < low) | (_number(c) > high)
        out.append((f"range:{c}", "WARNING", bad, f"values not between {low} and {high}"))
    for c, allowed in rules.categories.items():
        bad = ~F.coalesce(_cell(c).isin(*allowed), F.lit(False))
        out.append((f"category:{c}", "ERROR", bad, f"values that are none of {', '.join(map(str, allowed))}"))
    for c in rules.dates:
        bad = _cell(c).isNotNull() & parsed_date(_cell(c)).isNull()
        out.append((f"date:{c}", "WARNING", bad, "dates in no known format"))
    return [rule for rule in out if rule[0].split(":", 1)[1] in have]


def check(
    df: DataFrame, source: str, rules: dict[str, Rules] = RULES, batch_id: int | None = None
) -> DataFrame:
    """One finding per rule, all counted in a single pass; an unknown source has none."""
    entries = _rule_columns(df, rules[source]) if source in rules else []
    if not entries:
        return df.sparkSession.createDataFrame([], QUALITY_LOG)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(bad).alias(f"bad_{i}") for i, (_, _, bad, _) in enumerate(entries)],
    )
    findings = []
    for i, (rule, severity, _, message) in enumerate(entries):
        bad = F.col(f"bad_{i}")
        text = F.concat(F.lit(rule.split(":", 1)[1] + ": "), bad.cast("string"), F.lit(" " + message))
        findings.append(
            F.struct(
                F.lit(source).alias("source_table"),
                F.lit(rule).alias("validation_rule"),
                F.lit(severity).alias("severity"),
                F.current_timestamp().alias("validation_date"),
                F.col("total").alias("total_records"),
                (F.col("total") - bad).alias("valid_records"),
                bad.alias("invalid_records"),
                F.when(bad > 0, text).alias("error_details"),
                F.lit(batch_id).cast("bigint").alias("batch_id"),
            )
        )
    return counts.select(F.inline(F.array(*findings)))


def issues(findings: DataFrame) -> DataFrame:
    """Only the rules that some row breaks."""
    return findings.filter(F.col("invalid_records") > 0)


def tag(staged: DataFrame, source: str, rules: dict[str, Rules] = STAGED_RULES) -> DataFrame:
    """Set each staged row to VALID or INVALID with the reasons.

    A row is invalid when the fact load could not read it: a mandatory value is missing, the
    date does not parse, or a cell did not convert while staging (already noted in
    ``validation_errors``). Unusual but readable values stay findings of ``check``.
    """
    wanted = rules[source]
    have = set(staged.columns)
    notes = [F.when(_cell(c).isNull(), F.lit(f"{c} missing")) for c in wanted.mandatory if c in have]
    if wanted.dates:
        notes.append(F.when(F.col("date_parsed").isNull(), F.lit("date not readable")))
    errors = F.concat_ws("; ", F.col("validation_errors"), *notes)
    return staged.withColumns(
        {
            "validation_status": F.when(errors == "", "VALID").otherwise("INVALID"),
            "validation_errors": F.nullif(errors, F.lit("")),
        }
    )


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Foreign keys without a member, with their row count.

    The fact is reduced to one row per key before the join, so a hot key does not travel.
    """
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    members = dim.select(F.col(dim_key or key).alias(key))
    return used.join(members, key, "left_anti")


def violations(df: DataFrame, checks: dict[str, str]) -> DataFrame:
    """Rows that break each named SQL condition; an unknown condition passes."""
    bad = [F.count_if(~n.holds(F.expr(c))).alias(name) for name, c in checks.items()]
    counts = df.agg(F.count(F.lit(1)).alias("total_records"), *bad)
    rows = [
        F.struct(
            F.lit(name).alias("constraint_name"),
            F.col("total_records"),
            F.col(name).alias("invalid_records"),
        )
        for name in checks
    ]
    return counts.select(F.inline(F.array(*rows)))


def not_null_checks(columns: list[str]) -> dict[str, str]:
    return {f"nn_{c}": f"{c} IS NOT NULL" for c in columns}


# Declared business constraints.
SALES_CHECKS = {
    "ck_sales_qty_positive": "quantity_sold > 0",
    "ck_sales_price_positive": "unit_price_gbp > 0",
    "ck_sales_discount": "discount_rate BETWEEN 0 AND 0.25",
}
DAILY_CHECKS = {
    "ck_daily_print_run": "print_run_qty >= 0",
    "ck_daily_units_sold": "units_sold >= 0",
    "ck_daily_revenue": "revenue_gbp >= 0",
    "ck_daily_temp": "temperature_celsius BETWEEN -50 AND 60",
    "ck_daily_humidity": "humidity_pct BETWEEN 0 AND 100",
    "ck_daily_vendor_score": "vendor_score BETWEEN 0 AND 10",
}
TIME_CHECKS = {
    "ck_dim_time_dow": "day_of_week BETWEEN 1 AND 7",
    "ck_dim_time_month": "month_number BETWEEN 1 AND 12",
    "ck_dim_time_quarter": "quarter_number BETWEEN 1 AND 4",
}
VERSION_CHECKS = {"ck_current": "is_current IN ('Y', 'N')"}
VENDOR_CHECKS = {**VERSION_CHECKS, "ck_dim_vendor_score": "vendor_score BETWEEN 0 AND 10"}
TYPE_CHECKS = {"ck_physical": "is_physical IN ('Y', 'N')"}
CURRENCY_CHECKS = {"ck_base": "is_base_currency IN ('Y', 'N')"}
SALES_MANDATORY = [
    "time_key", "product_key", "author_key", "dc_key", "vendor_key", "channel_key",
    "product_type_key", "currency_key", "sale_number", "quantity_sold", "unit_price_original",
    "unit_price_gbp", "gross_amount_gbp", "net_amount_gbp", "print_run_qty", "binding_cost_gbp",
    "unit_cost_gbp", "total_cost_gbp", "gross_profit_gbp",
]
DAILY_MANDATORY = [
    "time_key", "product_key", "dc_key", "vendor_key", "product_type_key", "print_run_qty",
    "binding_cost_gbp", "units_sold", "returns_qty", "net_units", "revenue_gbp",
    "unit_binding_cost", "cost_of_goods_sold", "gross_profit_gbp",
]


def impute_discount(df: DataFrame, how: str = "none", by: str = "chnl") -> DataFrame:
    """Fill ``discount_imputed`` where the discount is missing.

    ``none`` leaves it null (the amount then counts as undiscounted); ``channel_mean`` takes the
    mean discount of the row's channel, rounded to the four decimals the fact keeps.
    """
    if how == "none":
        return df.withColumn("discount_imputed", F.lit(None).cast(n.STAGED))
    if how != "channel_mean":
        raise ValueError(f"unknown imputation {how!r}")
    # four exact digits of sum / count, so partial sums in any order agree
    centre = n.mean(F.col("dscnt")).cast("decimal(38,10)").cast(n.DISCOUNT).cast(n.STAGED)
    means = df.groupBy(by).agg(centre.alias("_centre"))
    # one row per channel: adaptive execution broadcasts it by the size it turns out to have
    filled = df.join(means, by, "left")
    return filled.withColumn(
        "discount_imputed", F.when(F.col("dscnt").isNull(), F.col("_centre"))
    ).drop("_centre")
