"""Mixing sources to target weights: whole epochs, then weighted sampling without replacement.

Sources share the corpus's words by weight. A source's target stops at ``most`` times its own size and
the excess is shared by weight among the rest until no target is above its stop. Each source gives as
many complete epochs as fit its target; the rest of the target is filled by Efraimidis-Spirakis
sampling: a document with quality weight w and uniform u has the key -ln(u)/w, keys are sorted within
the source, sizes are prefix-summed, and documents are taken while the middle of a document lies in
the budget. So a source misses its target by at most half a document, and u comes from a digest of
the document, so reruns agree.

A source may hold any share of the rows: keys are cut into ``RANGES`` ranges, sizes are summed per
source and range before the shuffle, and only documents of one range are sorted together.

Size is the number of words; null text has none. Null sources are one source, ordered last. Documents
without words are never taken in part. Repeated rows are documents of their own; equal ones are
interchangeable. Null doc_ids are allowed. Columns named like the result's are replaced. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from foliomart.llm.stages import dropped, stored, unused

RANGES = 1024
WORD = "[^\\x20\\x09-\\x0D]+"
DIGITS = 12  # hexadecimal digits of the digest that make u


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_of(text: Column) -> Column:
    """Between 0 and 1: the share of characters that are not digits or symbols, smoothed."""
    odd = F.length(text) - F.length(F.translate(text, "0123456789#*$%&|<>{}[]_=+~^\\/@!", ""))
    return F.coalesce((F.length(text) - odd + 1.0) / (F.length(text) + 1.0), F.lit(1.0))


def uniform_of(*parts: Column) -> Column:
    """A uniform number in (0, 1) from a digest."""
    text = F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    number = F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")
    return (number.cast("double") + 0.5) / float(16**DIGITS)


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size) with weight and target; weights repeat along the sources' order.

    In the order of stop / weight the stopped sources come first, so one pass of running sums finds
    the share per weight that the others get. The windows hold one row per source.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.array(*[F.lit(int(x)) for x in weights])
    rows = sizes.withColumn("weight", F.get(w, F.pmod(rank, F.lit(len(weights)))).cast("long"))
    stop = F.col("source_size") * F.lit(most)
    every = W.partitionBy(F.lit(0))
    order = every.orderBy(F.col("stop") * F.lit(1.0) / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rows = (
        rows.withColumn("stop", stop)
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("free", F.col("total") - F.coalesce(F.sum("stop").over(before), F.lit(0)))
        .withColumn("heavy", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("stopped", F.col("free") * F.col("weight") >= F.col("stop") * F.col("heavy"))
        .withColumn("rest", F.col("total") - F.sum(F.when(F.col("stopped"), F.col("stop")).otherwise(0)).over(every))
        .withColumn("share", F.sum(F.when(F.col("stopped"), 0).otherwise(F.col("weight"))).over(every))
    )
    shared = F.col("rest").cast("double") * F.col("weight") / F.col("share")
    target = F.when(F.col("stopped"), F.col("stop").cast("double")).otherwise(F.least(shared, F.col("stop").cast("double")))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), most: int = 3, quality: Column | None = None, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: doc_id, size, source, source_size, target, taken (words), copies; and the columns in ``keep``."""
    spark = docs.sparkSession
    body = F.col(text)
    u = uniform_of(F.col(doc_id), F.length(body), F.md5(body))
    key = -F.log(u) / (quality if quality is not None else quality_of(body))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size_of(body).alias("size"), key.alias("key"), *keep
    )
    # keys of a source lie on (0, inf); 1 - exp(-key) spreads them over (0, 1)
    ranged = rows.withColumn("range", F.floor((1.0 - F.exp(-F.col("key"))) * RANGES).cast("int"))
    ranged = ranged.withColumn("at", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")))
    ranged = stored(ranged, "sized")
    sums = ranged.groupBy("at", "source", "range").agg(F.sum("size").alias("words"))
    sums = stored(sums, "range-sums")
    goal = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    goal = goal.withColumn("at", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))).drop("source")
    ahead = F.coalesce(F.sum("words").over(W.partitionBy("at").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    plan = sums.select("at", "range", ahead.alias("ahead")).join(goal, "at")
    plan = stored(plan, "mix-plan")
    dropped(sums)
    inside = F.sum("size").over(
        W.partitionBy("at", "range").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    )
    joined = ranged.withColumn("upto", inside).join(plan, ["at", "range"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1).cast("long")
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    middle = F.col("ahead") + F.col("upto") - F.col("size") / 2.0
    more = F.when((F.col("size") > 0) & (middle <= budget), 1).otherwise(0)
    return (
        joined.withColumn("epochs", epochs)
        .withColumn("copies", F.least(F.col("epochs") + more, F.lit(most)).cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("doc_id", "size", "source", "source_size", "target", "taken", "copies", *keep)
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: a row per copy, with the columns of ``docs``."""
    spark = docs.sparkSession
    row, times, copy = (unused(name, docs.columns) for name in ("_row", "_copies", "_copy"))
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "unmixed")
    copies = mix(rows, keep=(row,), **options).where("copies > 0").select(row, F.col("copies").cast("int").alias(times))
    return (
        rows.join(copies, row).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
        .select(docs.columns)
    )
