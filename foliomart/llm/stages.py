"""Intermediate results of an operator, written to the folder all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from foliomart.session import discard, release, saved, scratch_path

#: Tables written in the scope that is open, and those that the scope before left.
_open: list[str] | None = None
_left: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once and go on from the written table; let go of what led to it.

    What follows neither recomputes it nor depends on executors that may be gone. The shuffle files
    behind it are not needed any more, so Spark is asked to delete them.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    made = saved(df, path)
    made.stored_at = path
    if _open is not None:
        _open.append(path)
    release(spark)
    return made


def unused(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it (Spark does not tell case apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def dropped(*frames: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for frame in frames:
        discard(frame.sparkSession, frame.stored_at)


#: Documents handed to Python at a time. Spark's own 10,000 would be tens of megabytes of text, held several
#: times over by the JVM's buffers and by each worker.
BATCH = 1000


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """A stage of a pipeline whose result is written before the next stage begins.

    What a stage returns still reads tables it stored, so they are deleted when the next one begins.
    The session is left with Arrow batches of at most ``BATCH`` rows, as the stage runs when its result
    is written; results do not depend on it.
    """
    global _open, _left
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH:
        spark.conf.set(setting, str(BATCH))
    for path in _left:
        discard(spark, path)
    _left, _open = [], []
    try:
        yield
    finally:
        _left, _open = _open, None
