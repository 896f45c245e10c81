"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir); what it returns is written as Parquet and read again as the
next stage's documents. All but the last return the columns of documents. What a stage stored on the
way is deleted when the next one begins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomart.llm import mixture, neardup, packing, quality, repeats
from foliomart.llm.entries import vocabulary_path
from foliomart.llm.stages import scope
from foliomart.session import saved, scratch_path


def _like(result: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of documents, with the character count of the text as it is now."""
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return result.select(docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that recur across their source."""
    with scope(spark):
        return _like(quality.cleaned(quality.judge(docs)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, similarity 0.8)."""
    with scope(spark):
        return neardup.near_duplicates(docs).where("kept").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document holds are cut out."""
    with scope(spark):
        return _like(repeats.without_repeats(docs), docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    with scope(spark):
        return mixture.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    with scope(spark):
        found = packing.pack(docs, vocabulary_path())
    return found.select("doc_id", "source", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mixture", source_mixture),
    ("packed sequences", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), scratch_path(spark, name.replace(" ", "-")))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The MinHash, matching-statistics and tokenizer stages have no SQL form; tests use brute force.
ORACLE_SQL = None
