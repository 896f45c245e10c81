"""Staging frames: typed source columns plus tracking, and the processed / archived split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomart.functions import numeric as n
from foliomart.functions.dates import parsed_date
from foliomart.operators.lookups import matching
from foliomart.schemas import NUMERIC_COLUMNS, SOURCE_COLUMNS, STAGING_ID, staging_schema


def stage(
    rows: DataFrame,
    source: str,
    filename: Column | None = None,
    first_id: int | Column = 1,
    load_date: Column | None = None,
) -> DataFrame:
    """Source columns under staging names, numbers typed, tracking columns set to PENDING / N.

    A cell that is no number is named in ``validation_errors``. Ids follow the file order (unique, not dense); write the result before using them further.
    """
    if source not in SOURCE_COLUMNS:
        raise ValueError(f"unknown source {source!r}")
    have = set(rows.columns)
    numeric = set(NUMERIC_COLUMNS[source])
    first = first_id if isinstance(first_id, Column) else F.lit(first_id)
    values = {STAGING_ID[source]: first + F.monotonically_increasing_id()}
    bad = []
    for header, column in SOURCE_COLUMNS[source].items():
        cell = F.col(f"`{header}`") if header in have else F.lit(None).cast("string")
        text = F.nullif(F.trim(cell), F.lit(""))
        if column in numeric:
            values[column] = n.fit(text, n.STAGED)
            bad.append(F.when(n.overflowed(text, n.STAGED), F.lit(f"{column} not a number")))
        else:
            values[column] = F.nullif(cell, F.lit(""))
        if column == "date_stamp":
            values["date_parsed"] = parsed_date(cell)
        if column == "dscnt":
            values["discount_imputed"] = F.lit(None)
    values |= {
        "source_filename": F.col("_metadata.file_name") if filename is None else filename,
        "load_date": F.current_timestamp() if load_date is None else load_date,
        "validation_status": F.lit("PENDING"),
        "validation_errors": F.nullif(F.concat_ws("; ", *bad), F.lit("")),
        "processed_flag": F.lit("N"),
        "processed_date": F.lit(None),
    }
    schema = staging_schema(source)
    return rows.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def mark_processed(staged: DataFrame, fact: DataFrame, source: str) -> DataFrame:
    """Flag Y, with the load time, on rows the fact already holds (by ``source_record_id``)."""
    key = STAGING_ID[source]
    loaded = fact.select(
        F.col("source_record_id").cast(staged.schema[key].dataType).alias(key),
        F.col("load_date").alias("_loaded"),
    )
    done = F.col("_loaded").isNotNull()
    return (
        staged.join(loaded, key, "left")
        .withColumns(
            {
                "processed_flag": F.when(done, "Y").otherwise(F.col("processed_flag")),
                "processed_date": F.coalesce(F.col("_loaded"), F.col("processed_date")),
            }
        )
        .select(*staged.columns)
    )


def flagged(staged: DataFrame, flags: DataFrame, key: str) -> DataFrame:
    """The staged rows that stored flags (id, processed_date) name, flag Y."""
    taken = flags.select(F.col(key).cast(staged.schema[key].dataType).alias(key), F.col("processed_date").alias("_taken"))
    return staged.join(taken, key).withColumns({"processed_flag": F.lit("Y"), "processed_date": F.col("_taken")}).select(*staged.columns)


def ready(staged: DataFrame) -> DataFrame:
    """Rows a fact load takes: VALID and not processed. Order is the loader's concern."""
    return staged.filter((F.col("validation_status") == "VALID") & (F.col("processed_flag") == "N"))


def unprocessed(staged: DataFrame, fact: DataFrame, source: str) -> DataFrame:
    """``ready`` rows that the fact does not hold yet."""
    key = STAGING_ID[source]
    loaded = fact.select(F.col("source_record_id").cast(staged.schema[key].dataType).alias(key))
    todo = ready(staged)
    return todo.join(matching(loaded, todo, [key]), key, "left_anti")


def archive(staged: DataFrame, archived: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(processed rows the archive lacks, rows that stay in staging)."""
    done = F.coalesce(F.col("processed_flag") == "Y", F.lit(False))
    to_archive = staged.filter(done).join(
        archived.select(STAGING_ID[source]), STAGING_ID[source], "left_anti"
    )
    return to_archive, staged.filter(~done)


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same columns: how an archive or a truncated staging table starts."""
    return df.limit(0)


def empty_staging(spark: SparkSession, source: str) -> DataFrame:
    return spark.createDataFrame([], staging_schema(source))
