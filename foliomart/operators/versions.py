"""A stored type 2 history that takes extracts in any order and rewrites only what they change.

Current and closed versions are stored apart, in hash buckets of the natural key. An extract is compared
with the current versions of its buckets; a bucket in which something changed gets its current versions
anew, versions that close are added to the closed ones as a portion of the extract. Closed versions are
not read, nor are the other buckets.

Every extract is also kept as it came (``observed``, appended). An extract older than one that
came before is late for the keys it changes: such a key's timeline is laid out again from all that was observed of it, so a version
goes in between, its neighbours get shorter, and a version that was seen on both sides is cut in two.
The result does not depend on the order of the extracts. Closed rows that a late extract changes are
written again, and the last row of a surrogate key counts.

Surrogate keys are stable: the version that holds an old version's first day with the same values keeps
its key, so facts go on pointing to it. What differs on the first day of the current version corrects it.
A day that is delivered again replaces what was observed on it; where that
makes two versions one, the key of the later one ends. Keys absent from an extract keep their
versions; rows without a key are left out; of several rows of a key the largest counts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliomart.operators.keys import assign_keys
from foliomart.operators.scd2 import scd2_history
from foliomart.schemas import schema_of
from foliomart.session import discard, saved, scratch_path
from foliomart.sources.warehouse import Warehouse

BUCKETS = 64
NOTES = schema_of("portion bigint, day date, last_key bigint, late bigint, buckets bigint")
_SPAN = schema_of("effective_date date, expiry_date date, is_current string, record_version int").fields


class VersionStore:
    """The versions of one dimension below a warehouse."""

    def __init__(
        self, warehouse: Warehouse, table: str, key: T.StructField, tracked: list[T.StructField], surrogate: str,
        first_key: int = 1000, buckets: int = BUCKETS,
    ):
        self.warehouse, self.table, self.surrogate, self.first_key, self.buckets = warehouse, table, surrogate, first_key, buckets
        self.key, self.tracked = key.name, [f.name for f in tracked]
        self.schema = T.StructType([T.StructField(surrogate, T.LongType()), key, *tracked, *_SPAN])
        self._observed = T.StructType([key, *tracked, T.StructField("day", T.DateType())])

    # --- reading

    def notes(self) -> list:
        return self.warehouse.read(f"{self.table}/notes", NOTES).orderBy("portion").collect()

    def _rows(self, live: str, buckets: list[int] | None = None) -> DataFrame:
        found = self.warehouse.read(f"{self.table}/rows", self.schema)
        if "bucket" not in found.columns:
            return found.withColumns({"bucket": F.lit(0), "portion": F.lit(0)})
        found = found.filter(F.col("live") == live).drop("live")
        return found if buckets is None else found.filter(F.col("bucket").isin(*buckets) if buckets else F.lit(False))

    def current(self) -> DataFrame:
        return self._rows("Y").select(self.schema.names)

    def closed(self, buckets: list[int] | None = None, late: bool | None = None) -> DataFrame:
        rows = self._rows("N", buckets)
        if late if late is not None else any(n["late"] for n in self.notes()):
            # the last row of a key counts, and a key that is current again has none
            last = rows.groupBy(self.surrogate).agg(F.max_by(F.struct(*rows.columns), "portion").alias("_r")).select("_r.*")
            rows = last.filter("is_current = 'N'")
        return rows.select(self.schema.names)

    def versions(self) -> DataFrame:
        return self.current().unionByName(self.closed())

    # --- writing

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _equal(self, left: str, right: str) -> Column:
        parts = [F.struct(*[F.col(f"{side}.{c}") for c in self.tracked]) for side in (left, right)]
        return parts[0].eqNullSafe(parts[1])

    def merge(self, extract: DataFrame, day: dt.date) -> dict[str, int]:
        """Take in an extract (key and tracked columns) that says what holds from ``day``; how many partitions it wrote."""
        w, spark = self.warehouse, self.warehouse.spark
        work = scratch_path(spark, "versions")
        notes = self.notes()
        portion = max((n["portion"] for n in notes), default=0) + 1
        rows = extract.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.max(F.struct(*self.tracked)).alias("new"))
        rows = saved(rows.withColumn("bucket", self._bucket()), f"{work}/rows")
        seen = rows.select(self.key, "new.*", F.lit(day).alias("day"), "bucket", F.lit(portion).alias("portion"))
        seen.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "portion").parquet(w.path(f"{self.table}/observed"))
        asked = sorted(r[0] for r in rows.select("bucket").distinct().collect())
        live = self._rows("Y", asked).select(self.key, F.struct(*self.schema.names).alias("old"))
        both = rows.join(live, self.key, "left")
        started = F.col("old.effective_date")
        # behind another extract, the current version may have been seen again after this day
        behind = F.lit(any(n["day"] > day for n in notes))
        kind = (
            F.when(F.col("old").isNull(), "new").when(started > F.lit(day), "late").when(self._equal("old", "new"), "same")
            .when(behind, "late").when(started == F.lit(day), "fixed").otherwise("changed")
        )
        judged = saved(both.withColumn("kind", kind).filter("kind <> 'same'"), f"{work}/judged")
        touched = judged.groupBy("bucket").agg(F.count_if(F.col("kind") == "late").alias("late")).collect()
        buckets, late = sorted(r["bucket"] for r in touched), sum(r["late"] for r in touched)
        top = max((n["last_key"] for n in notes), default=self.first_key - 1)
        if buckets:
            top = self._write(judged, buckets, late, day, portion, top, any(n["late"] for n in notes), work)
        note = [(portion, day, top, late, len(buckets))]
        w.append(f"{self.table}/notes", spark.createDataFrame(note, NOTES).coalesce(1))
        discard(spark, work)
        return {"buckets": len(buckets), "late": late}

    def _write(self, judged: DataFrame, buckets: list[int], late: int, day: dt.date, portion: int, top: int, was_late: bool, work: str) -> int:
        w = self.warehouse
        none = F.lit(None).cast("date")

        def version(**values: Column) -> Column:
            return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields])

        old = {c: F.col("old").getField(c) for c in self.schema.names}
        new = {c: F.col("new").getField(c) for c in self.tracked}
        opened = version(
            **{self.surrogate: F.lit(None), self.key: F.col(self.key)}, **new, effective_date=F.lit(day), expiry_date=none,
            is_current=F.lit("Y"), record_version=F.coalesce(old["record_version"], F.lit(0)) + 1,
        )
        shut = version(**{**old, "expiry_date": F.date_sub(F.lit(day), 1), "is_current": F.lit("N")})
        fixed = version(**{**old, **new})
        outcome = (
            F.when(F.col("kind") == "new", F.array(opened)).when(F.col("kind") == "fixed", F.array(fixed)).otherwise(F.array(opened, shut))
        )
        made = judged.filter("kind <> 'late'").select(F.explode(outcome).alias("r")).select("r.*")
        if late:
            made = made.unionByName(self._spliced(judged.filter("kind = 'late'").select(self.key), buckets, was_late))
        made = saved(made, f"{work}/made")
        added = made.filter(F.col(self.surrogate).isNull()).drop(self.surrogate)
        keyed = assign_keys(added, "effective_date", self.key, self.surrogate, top + 1, work=f"{work}/keyed")
        top = keyed.agg(F.max(self.surrogate)).first()[0] or top
        made = made.filter(F.col(self.surrogate).isNotNull()).unionByName(keyed).withColumn("bucket", self._bucket())
        others = self._rows("Y", buckets).join(judged.select(self.key), self.key, "left_anti").select(*self.schema.names, "bucket")
        live = others.unionByName(made.filter("is_current = 'Y'")).withColumns({"live": F.lit("Y"), "portion": F.lit(0)})
        shut_rows = made.filter("is_current = 'N'")
        if late:
            # also what is current now, in case it was closed before, and what is no version any more
            open_now = made.filter("is_current <> 'N'").join(judged.filter("kind = 'late'").select(self.key), self.key, "left_semi")
            shut_rows = shut_rows.unionByName(open_now.select(shut_rows.columns))
        shut_rows = shut_rows.withColumns({"live": F.lit("N"), "portion": F.lit(portion)})
        # written apart first, as the partitions read are the ones replaced
        whole = saved(live.unionByName(shut_rows), f"{work}/whole")
        (
            whole.hint("rebalance", F.col("bucket")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("live", "bucket", "portion").parquet(w.path(f"{self.table}/rows"))
        )
        return top

    def _spliced(self, keys: DataFrame, buckets: list[int], was_late: bool) -> DataFrame:
        """The timelines of some keys from all that was observed of them, under the surrogate keys they had."""
        seen = self.warehouse.read(f"{self.table}/observed", self._observed).filter(F.col("bucket").isin(*buckets))
        seen = seen.join(keys, self.key, "left_semi")
        daily = seen.groupBy(self.key, "day").agg(F.max_by(F.struct(*self.tracked), "portion").alias("s")).select(self.key, "day", "s.*")
        history = scd2_history(daily, self.key, self.tracked, "day").withColumn("new", F.struct(*self.tracked))
        had = self._rows("Y", buckets).select(self.schema.names).unionByName(self.closed(buckets, was_late)).join(keys, self.key, "left_semi")
        had = had.select(
            F.col(self.key).alias("_key"), F.struct(*self.tracked).alias("old"), F.col("effective_date").alias("_from"), self.surrogate,
            *[f.name for f in _SPAN],
        )
        inside = (F.col("_from") >= F.col("effective_date")) & (F.col("expiry_date").isNull() | (F.col("_from") <= F.col("expiry_date")))
        # the same values, or a corrected first day
        meant = inside & (self._equal("old", "new") | (F.col("_from") == F.col("effective_date")))
        found = history.join(had.drop(*[f.name for f in _SPAN]), (F.col(self.key) == F.col("_key")) & meant, "left")
        names = [self.key, *self.tracked, *[f.name for f in _SPAN]]
        laid = found.groupBy(*names).agg(F.min(self.surrogate).alias(self.surrogate)).select(self.schema.names)
        gone = had.join(laid.select(self.surrogate), self.surrogate, "left_anti").select(F.col("_key").alias(self.key), "old.*", self.surrogate, *[f.name for f in _SPAN])
        return laid.unionByName(gone.withColumn("is_current", F.lit("-")).select(self.schema.names))
