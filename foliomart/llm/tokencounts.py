"""Token counts by source, language and tokenizer version, maintained from signed deltas.

A batch is a frame of signed facts: an insert counts +, a delete -, a revised count is a delete of the
old number and an insert of the new one. A commit sums its facts per group (map-side first) and writes
them to a folder of the batch's name. Totals are the sums over all committed batches, so they are the
same whatever the order of commits. A commit is idempotent: a batch that is already complete is left
alone; one that was cut off before Spark marked it complete is written anew. Compaction writes the
totals as one batch and names the batches it stands for, which are then neither read nor committed
again.

Null source, language or version is a group of its own. Null counts are 0 tokens; a null sign is an
insert. Groups whose documents and tokens are all taken back are left out. Empty
batches are recorded as committed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliomart.llm.stages import stored

KEYS = ("source", "lang", "tokenizer")
STORED = T.StructType(
    [T.StructField(k, T.StringType()) for k in KEYS] + [T.StructField("n_docs", T.LongType()), T.StructField("n_tokens", T.LongType())]
)
#: Tokenizer versions that need no vocabulary: words, and words apart from marks (fixed values).
VERSIONS = {
    "words-1": "[^\\x20\\x09-\\x0D]+",
    "words-2": "[A-Za-z0-9\\x{C0}-\\x{24F}]+|[^A-Za-z0-9\\x{C0}-\\x{24F}\\x20\\x09-\\x0D]",
}


def counted(
    docs: DataFrame, version: str, text: str = "text", tokens: Column | None = None, times: Column | None = None
) -> DataFrame:
    """Facts of documents: source, lang, tokenizer, tokens, sign (how many documents a row adds)."""
    if tokens is None:
        tokens = F.regexp_count(F.col(text), F.lit(VERSIONS[version]))
    return docs.select(
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.lit(version).alias("tokenizer"), F.coalesce(tokens, F.lit(0)).cast("long").alias("tokens"),
        (F.lit(1) if times is None else times).cast("long").alias("sign"),
    )


def deletes(facts: DataFrame) -> DataFrame:
    return facts.withColumn("sign", -F.coalesce(F.col("sign"), F.lit(1)))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Facts that take the old counts back and put the new ones in."""
    return deletes(old).unionByName(new)


class Rollup:
    """Totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, name: str = "") -> list[str]:
        path, system = self._path(name)
        if not system.exists(path):
            return []
        return [s.getPath().getName() for s in system.listStatus(path) if s.isDirectory()]

    def _complete(self, name: str) -> bool:
        path, system = self._path(f"{name}/_SUCCESS")
        return system.exists(path)

    def batches(self) -> list[str]:
        """Committed batches, with those that a compaction stands for."""
        found = {n.removeprefix("batch=") for n in self._listed() if n.startswith("batch=") and self._complete(n)}
        return sorted(found | self._replaced())

    def _compactions(self) -> list[str]:
        return sorted((n for n in self._listed() if n.startswith("compact=") and self._complete(f"{n}/names")), reverse=True)

    def _replaced(self) -> set[str]:
        newest = self._compactions()[:1]
        return {r[0] for n in newest for r in self.spark.read.parquet(f"{self.folder}/{n}/names").collect()}

    def commit(self, batch: str, facts: DataFrame) -> bool:
        """Add a batch; False if it was there already."""
        if not re.fullmatch("[A-Za-z0-9._-]+", batch):
            raise ValueError("a batch is named with letters, digits, dot, dash and underscore")
        if batch in self.batches():
            return False
        sign = F.coalesce(F.col("sign"), F.lit(1))
        facts.groupBy(*KEYS).agg(
            F.sum(sign).cast("long").alias("n_docs"), F.sum(sign * F.coalesce(F.col("tokens"), F.lit(0))).cast("long").alias("n_tokens")
        ).write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")
        return True

    def _parts(self) -> list[str]:
        newest, gone = self._compactions()[:1], self._replaced()
        own = [f"{self.folder}/batch={b}" for b in self.batches() if b not in gone]
        return [f"{self.folder}/{n}/totals" for n in newest] + own

    def totals(self) -> DataFrame:
        parts = self._parts()
        stored = self.spark.read.schema(STORED).parquet(*parts) if parts else self.spark.createDataFrame([], STORED)
        sums = stored.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 OR n_tokens <> 0")

    def compact(self) -> None:
        """Store the totals once, then the names of the batches in them: the names make it valid."""
        names = self.batches()
        number = max([int(n.removeprefix("compact=")) for n in self._listed() if n.startswith("compact=")], default=0) + 1
        to = f"{self.folder}/compact={number:08d}"
        self.totals().write.mode("overwrite").parquet(f"{to}/totals")
        self.spark.createDataFrame([(n,) for n in names], "name string").write.mode("overwrite").parquet(f"{to}/names")


def maintained(docs: DataFrame, folder: str) -> Rollup:
    """Totals of documents after four commits: all documents in words-1; all but one of the exact copies
    within a source and language taken back; the rest revised to words-2; and the second commit once
    more, which changes nothing."""
    rollup = Rollup(docs.sparkSession, folder)
    again = ["source", "lang", "digest"]
    rows = docs.withColumn("digest", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    both = rows.select(
        "source", "lang", "digest",
        F.coalesce(F.regexp_count("text", F.lit(VERSIONS["words-1"])), F.lit(0)).alias("one"),
        F.coalesce(F.regexp_count("text", F.lit(VERSIONS["words-2"])), F.lit(0)).alias("two"),
    )
    both = stored(both, "counted")
    rollup.commit("load", counted(both, "words-1", tokens=F.col("one")))
    # equal texts have equal counts: n - 1 of n copies go, found without joining or sorting copies
    held = both.groupBy(*again).agg(
        F.count(F.lit(1)).alias("n"), F.max("one").alias("one"), F.max("two").alias("two")
    )
    held = stored(held, "copies")
    copies = counted(held.where("n > 1"), "words-1", tokens=F.col("one"), times=1 - F.col("n"))
    rollup.commit("copies", copies)
    rollup.commit("revision", revised(counted(held, "words-1", tokens=F.col("one")), counted(held, "words-2", tokens=F.col("two"))))
    rollup.commit("copies", copies)
    return rollup
