"""Dimension lookups: broadcast behind a size check, otherwise a shuffled join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomart.session import saved

# Dimension columns have declared widths (a row is under 1 KB), so this many rows stay
# below 200 MB on every executor.
BROADCAST_ROWS = 200_000


class Star(dict):
    """Dimensions by name. Row counts are taken once, by one job, when first needed."""

    _rows: dict[str, int] | None = None

    def rows(self, name: str) -> int:
        if self._rows is None:
            counts = [
                dim.agg(F.count(F.lit(1)).alias("n")).select(F.lit(key).alias("name"), "n")
                for key, dim in self.items()
            ]
            self._rows = {r["name"]: r["n"] for r in reduce(DataFrame.unionByName, counts).collect()}
        return self._rows[name]

    def sized(self, name: str, derived: DataFrame | None = None, work: str | None = None) -> DataFrame:
        """The dimension, or a frame with no more rows than it, marked for broadcast if small.

        A large derived frame is written to ``work`` and read again. Spark then shuffles both sides
        as they are and adaptive execution splits the partitions a hot key fills, which it does
        not do where a side is an aggregate. Its file may be small enough for Spark to broadcast it,
        which the driver's memory would pay for, hence the hint.
        """
        df = self[name] if derived is None else derived
        if self.rows(name) <= BROADCAST_ROWS:
            return F.broadcast(df)
        return df if derived is None or work is None else saved(df, f"{work}/lookup-{name}").hint("merge")


def sized(side: DataFrame) -> DataFrame:
    """Mark a side for broadcast if a count finds it small."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


def shuffled_if_large(side: DataFrame) -> DataFrame:
    """Keep Spark from broadcasting a side of many rows because its file is small."""
    return side.hint("merge") if side.count() > BROADCAST_ROWS else side


def attach(rows: DataFrame, side: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a side that is usually small; its size is counted before it is broadcast."""
    return rows.join(sized(side), on, how)


def matching(large: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Key columns of ``large``, those that also occur in ``keys`` at least; for a semi or anti join with ``keys``.

    A load asks a large fact about the few keys of its batch: those are broadcast if counted
    small, and the fact is then filtered in place instead of being shuffled. Many keys would be
    shuffled once more only to be joined again, so then all rows are left to that join.
    """
    if keys.count() > BROADCAST_ROWS:
        return large.select(*on)
    return large.select(*on).join(F.broadcast(keys.select(*on).distinct()), on, "left_semi")


def current(dim: DataFrame) -> DataFrame:
    """Current versions; dimensions without history are all current."""
    return dim.filter(F.col("is_current") == "Y") if "is_current" in dim.columns else dim


def unique_by(dim: DataFrame, key: Column, values: list[str], name: str) -> DataFrame:
    """One row per natural key: its values, and how many members share it.

    Two members under one key must not multiply the looked-up rows, so the caller rejects them.
    """
    return dim.groupBy(key.alias(f"_{name}_on")).agg(
        F.min(F.struct(*values)).alias(f"_{name}"), F.count(F.lit(1)).alias(f"_{name}_n")
    ).filter(F.col(f"_{name}_on").isNotNull())


def looked_up(name: str, value: str) -> Column:
    """The value of the one member found, null if there is none."""
    return F.col(f"_{name}").getField(value)


def ambiguous(name: str) -> Column:
    return F.coalesce(F.col(f"_{name}_n") > 1, F.lit(False))


def view(dim: DataFrame, key: str, natural: str, version: str = "as_recorded") -> DataFrame:
    """Members as the facts should see them, one row per surrogate key.

    ``as_recorded`` keeps current versions only, so facts of expired versions drop out;
    ``latest`` leads every version to the current attributes of its natural key.
    """
    if version == "as_recorded" or "is_current" not in dim.columns:
        return current(dim)
    if version != "latest":
        raise ValueError(f"unknown version {version!r}")
    return dim.select(key, natural).join(current(dim).drop(key), natural)
