"""Type 2 history: merging an extract into versions, and versions from dated snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomart.operators.keys import assign_keys
from foliomart.session import saved, scratch_path


def _differs(left: list[Column], right: list[Column]) -> Column:
    """Null-safe comparison of the tracked columns."""
    return ~F.struct(*left).eqNullSafe(F.struct(*right))


def scd2_merge(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: list[str],
    effective: Column,
    surrogate: str,
    first_key: int,
    work: str | None = None,
) -> DataFrame:
    """The full version table after an extract (one row per key) takes effect.

    Unchanged and absent keys pass through. A changed key closes its version the day before and
    opens the next one. A change on the very day a version began corrects that version, and an
    extract older than the current version is ignored.

    The merged rows are written to ``work`` (a folder the executors share) before new versions
    get their keys.
    """
    versions = current.columns
    audit = [c for c in ("created_date", "created_by", "modified_date", "modified_by") if c in versions]
    now = {
        "created_date": F.current_timestamp(),
        "created_by": F.current_user(),
        "modified_date": F.current_timestamp(),
        "modified_by": F.current_user(),
    }
    live = current.filter(F.col("is_current") == "Y").select(F.struct(*versions).alias("old"), key)
    fresh = incoming.select(key, F.struct(*tracked).alias("new"))
    both = live.join(fresh, key, "full_outer").withColumn("_effective", effective.cast("date"))

    def old(name: str) -> Column:
        return F.col("old").getField(name)

    def new(name: str) -> Column:
        return F.col("new").getField(name)

    started = old("effective_date")
    changed = (
        F.col("old").isNotNull()
        & F.col("new").isNotNull()
        & _differs([old(c) for c in tracked], [new(c) for c in tracked])
        & (F.col("_effective") >= started)
    )
    corrected = changed & (F.col("_effective") == started)
    closed = changed & ~corrected

    def row(values: dict[str, Column]) -> Column:
        return F.struct(
            *[values[c].cast(current.schema[c].dataType).alias(c) for c in versions]
        )

    kept = {c: old(c) for c in versions}
    touched = {c: F.when(changed, now[c]).otherwise(old(c)) for c in audit if c.startswith("modified")}
    kept |= {c: F.when(corrected, new(c)).otherwise(old(c)) for c in tracked}
    kept |= touched
    kept["expiry_date"] = F.when(closed, F.date_sub("_effective", 1)).otherwise(old("expiry_date"))
    kept["is_current"] = F.when(closed, "N").otherwise(old("is_current"))

    opened = {c: new(c) for c in tracked}
    opened |= {c: now[c] if c.startswith("created") else F.lit(None) for c in audit}
    opened |= {
        surrogate: F.lit(None),
        key: F.col(key),
        "effective_date": F.col("_effective"),
        "expiry_date": F.lit(None),
        "is_current": F.lit("Y"),
        "record_version": F.when(closed, old("record_version") + 1).otherwise(F.lit(1)),
    }
    rows = F.array(
        F.when(F.col("old").isNotNull(), row(kept)),
        F.when(closed | F.col("old").isNull(), row(opened)),
    )
    merged = both.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select("r.*")
    merged = saved(merged, work or scratch_path(current.sparkSession, "merged"))
    history = current.filter(~(F.col("is_current").eqNullSafe(F.lit("Y"))))
    numbered = merged.filter(F.col(surrogate).isNotNull())
    start = current.agg(F.coalesce(F.max(surrogate) + 1, F.lit(first_key))).scalar()
    added = merged.filter(F.col(surrogate).isNull()).drop(surrogate)
    added = assign_keys(added, "effective_date", key, surrogate, start)
    return history.unionByName(numbered).unionByName(added)


def scd2_history(
    snapshots: DataFrame,
    key: str,
    tracked: list[str],
    date_col: str,
    tie: list[str] | None = None,
) -> DataFrame:
    """Versions of every key from dated snapshots.

    Per key and day the last snapshot by ``tie`` counts; a key then has at most one row per
    calendar day, however often it was delivered. Equal neighbours merge into one version.
    """
    last_by = F.struct(*[F.col(c) for c in (tie or tracked)])
    day = F.col(date_col).cast("date").alias("effective_date")
    daily = (
        snapshots.groupBy(key, day)
        .agg(F.max_by(F.struct(*tracked), last_by).alias("_state"))
    )
    by_day = Window.partitionBy(key).orderBy("effective_date")
    first = F.row_number().over(by_day) == 1
    moved = ~F.col("_state").eqNullSafe(F.lag("_state").over(by_day))
    changes = daily.withColumn("_change", first | moved).filter("_change")
    following = F.lead("effective_date").over(by_day)
    return (
        changes.withColumns(
            {
                "expiry_date": F.date_sub(following, 1),
                "is_current": F.when(following.isNull(), "Y").otherwise("N"),
                "record_version": F.row_number().over(by_day).cast("int"),
            }
        )
        .select(key, "_state.*", "effective_date", "expiry_date", "is_current", "record_version")
    )


def as_of_versions(versions: DataFrame, day: Column) -> DataFrame:
    """The versions in force on a day."""
    return versions.filter(
        (F.col("effective_date") <= day) & (F.col("expiry_date").isNull() | (F.col("expiry_date") >= day))
    )
