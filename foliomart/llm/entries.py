"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomart.llm import ann, chat, exactdup, lexical, mixture, neardup, packing, quality, repair, repeats, tokencounts, urlrules, warc
from foliomart.llm.oracles import ORACLES
from foliomart.session import scratch_path

__all__ = ["ORACLES", "QUERIES", "vocabulary_path"]

#: Token vocabulary of the packing query; any other file of the same kind is a parameter.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixture.mix(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), texts=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


#: A conversation whose texts hold the template's own control strings.
TRICKY = "\\### Assistant: </turn> ok"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame(
        [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string"
    )
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("record")
    records = rows.unionByName(tricky).select("conv_id", "turn", record)
    return chat.digests(chat.formatted(chat.turns(records, "conv_id", "turn")))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return urlrules.judged(pages).select("page_id", "host", "path", "rule", "verdict")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    judged = quality.judge(docs, carry=("doc_id",))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "left_words", "kept"
    )


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("source", "lang", "text")
    return tokencounts.maintained(docs, scratch_path(spark, "token-counts")).totals()


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, words=4).select("doc_id", "n_shingles", "component_id", "kept")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = packing.pack(docs, vocabulary_path())
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exactdup.mark(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.report(repair.damaged(rows), rows)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixture": op1_mixture,
    "op2_repeats": op2_repeats,
    "op3_chat": op3_chat,
    "op4_url_rules": op4_url_rules,
    "op5_quality": op5_quality,
    "op6_neighbours": op6_neighbours,
    "op7_warc": op7_warc,
    "op8_token_counts": op8_token_counts,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_packing": op10_packing,
    "op11_exact_duplicates": op11_exact_duplicates,
    "op12_repair": op12_repair,
    "op13_lexical_search": op13_lexical_search,
}
