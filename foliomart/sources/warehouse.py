"""Warehouse tables: appended Parquet, month-partitioned facts, replaceable versions, logs."""

from __future__ import annotations

import datetime as dt
import threading
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliomart.schemas import BATCH_LOG, QUALITY_LOG, STATUSES, STEP_LOG, schema_of
from foliomart.session import discard, few_rows

_VERSIONS = schema_of("version bigint, committed_at timestamp")


class Warehouse:
    """Tables below one root folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._guard = threading.Lock()
        self._appending: dict[str, threading.Lock] = {}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _parquet(self, path: str, schema: T.StructType | None) -> DataFrame | None:
        try:
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return reader.parquet(path)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame | None:
        """An appended table; an empty frame (or None without a schema) if nothing was written."""
        found = self._parquet(self.path(table), schema)
        if found is None and schema is not None:
            return few_rows(self.spark, [], schema)
        return found

    def append(self, table: str, df: DataFrame) -> None:
        # writers of one folder share its temporary files: the first to end would delete the other's
        with self._guard:
            turn = self._appending.setdefault(table, threading.Lock())
        with turn:
            df.write.mode("append").parquet(self.path(table))

    # --- versions: a table cannot be overwritten while it is read, so each replacement goes to
    # a new folder and counts only once its version is noted.

    def _committed(self, table: str) -> int | None:
        log = self.read(f"{table}/versions", _VERSIONS)
        return log.agg(F.max("version").alias("v")).first()["v"]

    def replace(self, table: str, df: DataFrame, keep: int = 2) -> int:
        """Write a new version and switch readers to it; ``keep`` versions stay for open readers."""
        version = (self._committed(table) or 0) + 1
        df.write.mode("overwrite").parquet(self.path(f"{table}/v={version}"))
        note = self.spark.range(0, 1, 1, 1).select(
            F.lit(version).cast("bigint").alias("version"), F.current_timestamp().alias("committed_at")
        )
        self.append(f"{table}/versions", note)
        if version > keep:
            discard(self.spark, self.path(f"{table}/v={version - keep}"))
        return version

    def current(self, table: str, schema: T.StructType | None = None) -> DataFrame | None:
        """The last committed version."""
        version = self._committed(table)
        if version is None:
            return None if schema is None else few_rows(self.spark, [], schema)
        return self.read(f"{table}/v={version}", schema)

    def append_to_current(self, table: str, df: DataFrame) -> None:
        """Add rows to the last committed version."""
        self.append(f"{table}/v={self._committed(table)}", df)

    # --- facts

    def write_fact(self, table: str, df: DataFrame, by_day: bool = False) -> None:
        write_fact(df, self.path(table), by_day=by_day)

    def next_batch_id(self, fact_table: str, schema: T.StructType) -> int:
        return next_batch_id(self.read(fact_table, schema))

    # --- logs: append-only; the latest line of a batch or step is its state

    def log_batch(
        self,
        batch_id: int,
        name: str,
        status: str,
        started: dt.datetime,
        processed: int | None = None,
        failed: int | None = None,
        error: str | None = None,
    ) -> None:
        line = log_line(self.spark, BATCH_LOG, status, started, processed, failed, error,
                        batch_id=batch_id, batch_name=name)
        self.append("log/batch", line)

    def log_step(
        self,
        batch_id: int,
        step_id: int,
        name: str,
        status: str,
        started: dt.datetime,
        processed: int | None = None,
        failed: int | None = None,
        error: str | None = None,
    ) -> None:
        line = log_line(self.spark, STEP_LOG, status, started, processed, failed, error,
                        batch_id=batch_id, step_id=step_id, step_name=name)
        self.append("log/step", line)

    def log_quality(self, findings: DataFrame) -> None:
        self.append("log/quality", findings)

    def batches(self) -> DataFrame:
        return latest_status(self.read("log/batch", BATCH_LOG), ["batch_id", "batch_name"])

    def steps(self) -> DataFrame:
        return latest_status(self.read("log/step", STEP_LOG), ["batch_id", "step_id", "step_name"])

    def quality(self) -> DataFrame:
        return self.read("log/quality", QUALITY_LOG)

    def next_log_id(self) -> int:
        log = self.read("log/batch", BATCH_LOG)
        return log.agg((F.coalesce(F.max("batch_id"), F.lit(0)) + 1).alias("id")).first()["id"]


def with_month(fact: DataFrame) -> DataFrame:
    """The partition column of a fact."""
    return fact.withColumn("year_month", F.floor(F.col("time_key") / 100).cast("int"))


def write_fact(fact: DataFrame, path: str, mode: str = "append", by_day: bool = False) -> None:
    """Write a fact partitioned by month and sorted for row-group pruning.

    The rebalance hint brings a month's rows together for large files, and lets adaptive
    execution split a month that is too big for one task. Rows fresh from a fact build lie in pieces by
    day already (``by_day``), so they are not shuffled again: a month has about as many files as pieces.
    Append is safe because rows whose key the fact holds were rejected before.
    """
    dealt = with_month(fact)
    (
        (dealt if by_day else dealt.hint("rebalance", F.col("year_month")))
        .sortWithinPartitions("year_month", "time_key", "product_key")
        .write.mode(mode)
        .option("compression", "zstd")
        .partitionBy("year_month")
        .parquet(path)
    )


def rewrite_months(fact: DataFrame, path: str) -> None:
    """Replace exactly the months present in ``fact``; it must not be read from ``path``."""
    (
        with_month(fact)
        .hint("rebalance", F.col("year_month"))
        .sortWithinPartitions("year_month", "time_key", "product_key")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year_month")
        .parquet(path)
    )


def in_months(fact: DataFrame, months: list[int] | None) -> DataFrame:
    """The partitions of a stored fact that hold the given months."""
    if months is None or "year_month" not in fact.columns:
        return fact
    return fact.filter(F.col("year_month").isin(*months)) if months else fact.limit(0)


def months_of(rows: DataFrame, day: str = "date_parsed") -> list[int]:
    """The months of some rows, as partition values; one number per calendar month."""
    month = (F.year(day) * 100 + F.month(day)).cast("int")
    found = rows.filter(F.col(day).isNotNull()).select(month.alias("m")).distinct()
    return sorted(r["m"] for r in found.collect())


def next_batch_id(fact: DataFrame) -> int:
    return fact.agg((F.coalesce(F.max("load_batch_id"), F.lit(0)) + 1).alias("id")).first()["id"]


def log_line(
    spark: SparkSession,
    schema: T.StructType,
    status: str,
    started: dt.datetime,
    processed: int | None,
    failed: int | None,
    error: str | None,
    **names: object,
) -> DataFrame:
    if status not in STATUSES:
        raise ValueError(f"unknown status {status!r}")
    done = status in ("COMPLETED", "FAILED", "CANCELLED")
    values = {
        **{name: F.lit(value) for name, value in names.items()},
        "start_time": F.lit(started),
        "end_time": F.current_timestamp() if done else F.lit(None),
        "status": F.lit(status),
        "records_processed": F.lit(processed),
        "records_failed": F.lit(failed),
        "error_message": F.lit(error),
        "created_by": F.current_user(),
        "created_date": F.current_timestamp(),
    }
    return spark.range(0, 1, 1, 1).select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def latest_status(log: DataFrame, keys: list[str]) -> DataFrame:
    """The last line per batch or step: an ended one wins over an open one."""
    rest = [c for c in log.columns if c not in keys]
    rank = F.struct(
        F.coalesce(F.col("end_time"), F.lit("1000-01-01").cast("timestamp")),
        F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status")),
    )
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_last"))
    return last.select(*keys, "_last.*")


def total_count(tables: list[DataFrame], condition: str = "true") -> DataFrame:
    """One row: how many rows of several tables meet a condition."""
    counts = [t.filter(condition).agg(F.count(F.lit(1)).alias("n")) for t in tables]
    return reduce(DataFrame.unionByName, counts).agg(F.sum("n").alias("n_rows"))
