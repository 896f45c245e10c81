"""Uniqueness by first arrival, and dense surrogate keys without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomart.operators.lookups import matching
from foliomart.session import saved, scratch_path

# Rows are numbered in pieces of about this many rows, or larger ones beyond so many pieces.
PIECE_ROWS = 100_000
MOST_PIECES = 20_000
# Hashes of repeated keys stay below 50 MB on the driver and every executor up to this many.
BROADCAST_HASHES = 500_000
# The rows of a key are sorted in one task up to about this many.
HOT_ROWS = 100_000


def first_per_key(
    df: DataFrame, key_cols: list[str], order_cols: list[str], existing: DataFrame | None = None
) -> DataFrame:
    """The first row per key; keys that ``existing`` holds have none.

    The filter on the row number lets each map task drop all but its own first row per key
    before the shuffle, so a key holding a third of the rows stays spread out.
    """
    window = Window.partitionBy(*key_cols).orderBy(*[F.asc_nulls_last(c) for c in order_cols])
    kept = df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")
    if existing is None:
        return kept
    return kept.join(matching(existing, df, key_cols), key_cols, "left_anti")


def rest_of(df: DataFrame, kept: DataFrame, identity: list[str]) -> DataFrame:
    """Rows not among ``kept``, matched by the full identity so that no key gathers its rows."""
    columns = list(dict.fromkeys(identity))
    winner = kept.select(*[F.col(c).alias(f"_w_{c}") for c in columns])
    return df.join(winner, [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in columns], "left_anti")


def later_rows(
    df: DataFrame, key_cols: list[str], order_cols: list[str], work: str, existing: DataFrame | None = None
) -> DataFrame:
    """Identities (``key_cols + order_cols``) of the rows that are not the first of their key, or whose key ``existing`` holds.

    Only hashes of the keys are shuffled to find those that occur again; the rows behind them are
    then compared exactly, without their other columns. More hashes than can be broadcast rule
    nothing out, so then the identities of all rows are compared. They are shuffled once, by key, and
    ranked there; of a hot key each map task sends one row, and its other rows are found by their
    full identity. Written to ``work``.
    """
    identity = list(dict.fromkeys([*key_cols, *order_cols]))
    rows, hashed = df.select(*identity), F.xxhash64(*key_cols)
    held = None if existing is None else matching(existing, df, key_cols)
    seen = rows.select(hashed.alias("_hash"), F.lit(1).alias("_n"))
    if held is not None:
        # a hash depends on the type
        alike = F.xxhash64(*[F.col(c).try_cast(df.schema[c].dataType) for c in key_cols])
        seen = seen.unionByName(held.select(alike.alias("_hash"), F.lit(2).alias("_n")))
    again = seen.groupBy("_hash").agg(F.sum("_n").alias("_n")).filter(F.col("_n") > 1)
    again = saved(again, f"{work}/repeated")
    is_hot = F.col("_n") > HOT_ROWS
    figures = again.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_hot).alias("hot")).first()
    if figures["n"] <= BROADCAST_HASHES:
        rows = rows.join(F.broadcast(again), hashed == F.col("_hash"), "left_semi")
    hot_rows = None
    if figures["hot"]:
        # at most one hash per HOT_ROWS rows
        hot = F.broadcast(again.filter(is_hot))
        hot_rows = rows.join(hot, hashed == F.col("_hash"), "left_semi")
        rows = rows.join(hot, hashed == F.col("_hash"), "left_anti")
    later = _ranked_later(rows, key_cols, order_cols, held)
    if hot_rows is not None:
        kept = first_per_key(hot_rows, key_cols, order_cols)
        if held is not None:
            kept = kept.join(held, key_cols, "left_anti")
        later = later.unionByName(rest_of(hot_rows, kept, identity))
    return saved(later, f"{work}/later")


def _ranked_later(rows: DataFrame, key_cols: list[str], order_cols: list[str], held: DataFrame | None) -> DataFrame:
    """The rows after the first of their key, and all of a key that ``held`` has; rows equal to the first rank like it."""
    columns, late = rows.columns, F.col("_rank") > 1
    if held is not None:
        rows = rows.join(held.select(*key_cols).distinct().withColumn("_held", F.lit(True)), key_cols, "left")
        late = late | F.col("_held").isNotNull()
    window = Window.partitionBy(*key_cols).orderBy(*[F.asc_nulls_last(c) for c in order_cols])
    return rows.withColumn("_rank", F.rank().over(window)).filter(late).select(*columns)


def first_valid(
    df: DataFrame, key_cols: list[str], order_cols: list[str], existing: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split rows into the first per key and the rest; keys already in ``existing`` all fail.

    ``key_cols + order_cols`` must identify a row.
    """
    kept = first_per_key(df, key_cols, order_cols, existing)
    return kept, rest_of(df, kept, [*key_cols, *order_cols])


def assign_keys(
    df: DataFrame,
    day_col: str,
    id_col: str,
    key: str,
    start: int | Column,
    pieces: int | None = None,
    work: str | None = None,
    later: DataFrame | None = None,
) -> DataFrame:
    """Number rows densely from ``start`` by day (without one first) and id.

    Rows are partitioned by ranges of day and id and sorted in their partition. Spark samples the
    bounds, so pieces are about even however the ids of a day crowd together or lie apart; equal
    rows of day and id stay in one piece. The sorted rows are written to ``work`` (a folder the
    executors share) with their place in the piece, pieces are counted from what was written, and
    the counts add up to a first number per piece. That is one shuffle, without a window over
    rows, and later steps cannot see other bounds. ``pieces`` is their number; without it there
    is one per ``PIECE_ROWS`` rows, at most ``MOST_PIECES``.

    With ``later`` (identities, day and id among their columns) the rows named there get no number, and
    of rows with equal identity one does. The identities are dealt by day and id like the rows, so
    rows meet them in their piece and are shuffled once however many there are.
    """
    spark = df.sparkSession
    if pieces is None:
        pieces = min(max(1, -(-df.count() // PIECE_ROWS)), MOST_PIECES)
    dealt = df if later is None else df.withColumn("_rank", F.lit(1)).unionByName(
        later.withColumn("_rank", F.lit(0)), allowMissingColumns=True
    )
    order = ["_day", id_col]
    dealt = dealt.withColumn("_day", F.coalesce(F.col(day_col), F.lit("1000-01-01").cast("date"))).repartitionByRange(pieces, *order)
    if later is not None:
        same = Window.partitionBy(*order, *[c for c in later.columns if c != id_col]).orderBy("_rank")
        dealt = dealt.withColumn("_rn", F.row_number().over(same)).filter((F.col("_rn") == 1) & (F.col("_rank") == 1))
    lined_up = dealt.sortWithinPartitions(*order).select(*df.columns)
    # the partition's number from bit 33 on, the row's place in it below
    lined_up = saved(lined_up.withColumn("_at", F.monotonically_increasing_id()), work or scratch_path(spark, "numbered"))
    piece = F.shiftright("_at", 33)
    counts = lined_up.groupBy(piece.alias("_piece")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per piece
    earlier = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    first = start if isinstance(start, Column) else F.lit(start)
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = lined_up.join(F.broadcast(offsets), piece == F.col("_piece"))
    return numbered.select((first + F.col("_before") + place).cast("bigint").alias(key), *df.columns)
