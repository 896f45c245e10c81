"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def session(app: str = "foliomart", **conf: str) -> SparkSession:
    """A session with the settings the library relies on; extra settings win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine: on a cluster
    the executors could not see it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="foliomart-")
    context.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/foliomart/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, path: str) -> DataFrame:
    """Write a frame once and go on from the written table.

    What follows neither recomputes it nor depends on executors that may be gone, and reads only
    the columns it needs.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows the driver knows, as literals: rows handed over from Python would start a Python worker to be read."""
    def line(row: tuple) -> list[Column]:
        return [F.lit(value).cast(f.dataType).alias(f.name) for f, value in zip(schema.fields, row, strict=True)]

    if not rows:
        return spark.range(0).select(*line((None,) * len(schema.fields)))
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*[F.struct(*line(row)) for row in rows])))


def together(*works: Callable[[], object]) -> list:
    """Results of works that do not depend on each other; their Spark jobs run side by side.

    All of them end before the first failure, in the order given, is raised.
    """
    if not works:
        return []
    with ThreadPoolExecutor(len(works)) as pool:
        started = [pool.submit(inheritable_thread_target(work)) for work in works]
    return [one.result() for one in started]


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files and broadcasts that nothing refers to any more.

    It does so only when the driver collects its garbage, which may be too late for the executors' disks. The plan
    of the last job stays in the listeners' hands until another job ends, hence the small one.
    """
    spark.range(0, 1, 1, 1).count()
    gc.collect()
    spark._jvm.System.gc()


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
