"""Quality rules: measures inside a document, and lines that recur across documents of a host.

A line is normalised (white space collapsed, A-Z lower-cased, digits as 0) and hashed. For each host
(any column; null is a host of its own) the distinct documents that hold a line are counted. A line
above the limit is removed however much of a page it fills, unless it belongs to copies of a few texts:
these are the business of the duplicate stages, and removing their lines would reject every copy. It
does if in at least half of its documents it stands between the same lines (blank ones aside), and if
its documents are not more texts than the limit. The text of a document is what it says beside lines
above the limit: its other lines, in any order. Left out of it are runs of lines in the place of
lines above the limit (one that adjoins the run has a fixed line on that side), as edited copies have
them. Documents that say nothing else are told apart as the duplicate stage would: whole texts joined
by five-word shingles and a similarity of 0.8 are one. A document is rejected if a rule on its own text
fails or if too few words are left (depleted).

Null text counts as empty; an empty document has no words and fails the word minimum. Repeated rows
of one doc_id count as one document, rows without one by their texts. Rows keep their columns; the names added here are replaced if
present. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliomart.llm import neardup
from foliomart.llm.texts import encoded, mixed, slices, window_hashes, word_hashes
from foliomart.llm.stages import dropped, stored

SYMBOLS = b"#*$%&|<>"
GAPS = b" \t\n\x0b\x0c\r"
_DIGITS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")

MEASURES = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("line_hash", T.ArrayType(T.LongType())),
        T.StructField("line_words", T.ArrayType(T.IntegerType())),
    ]
)


def repeated_words(words: np.ndarray, n: int = 3) -> int:
    """Words covered by n-word windows that occur twice or more."""
    windows = window_hashes(words, n)
    if len(windows) < 2:
        return 0
    _, back, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[back] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(words), bool)
    for i in range(n):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def _measured(texts: list[bytes], min_words: int, most_repeated: int) -> list[dict]:
    words, off = word_hashes(texts)
    parts = [x.split(b"\n") for x in texts]
    flat = line_hashes_grouped(parts)
    rows = []
    for i, text in enumerate(texts):
        n = int(off[i + 1] - off[i])
        lines = [x.strip(GAPS) for x in parts[i]]
        seen = Counter(x for x in parts[i] if x.strip(GAPS))
        repeated = repeated_words(words[off[i] : off[i + 1]])
        chars = len(text) - sum(text.count(g) for g in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
        tails = int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))
        rows.append(
            {
                "n_words": n,
                "word_chars": chars - tails,
                "n_symbols": sum(text.count(bytes([s])) for s in SYMBOLS),
                "n_dup_lines": sum(seen.values()) - len(seen),
                "n_repeat_words": repeated,
                "base_failed": n < min_words or 100 * repeated > most_repeated * n,
                "line_hash": flat[i].view(np.int64).tolist(),
                "line_words": [len(x.split()) for x in lines],
            }
        )
    return rows


def line_hashes_grouped(parts: list[list[bytes]]) -> list[np.ndarray]:
    """Line hashes of several documents, hashed together."""
    hashes = line_hashes([line for lines in parts for line in lines])
    ends = np.cumsum([len(x) for x in parts])
    return np.split(hashes, ends[:-1]) if len(parts) else []


def line_hashes(lines: list[bytes]) -> np.ndarray:
    """Hash of each normalised line from its words and their places; 0 for a line without words."""
    words, off = word_hashes([x.translate(_DIGITS) for x in lines])
    counts = np.diff(off)
    out = np.zeros(len(lines), np.uint64)
    if len(words):
        place = (np.arange(len(words)) - np.repeat(off[:-1], counts)).astype(np.uint64)
        weighed = mixed(words + mixed(place + np.uint64(1)))
        full = np.flatnonzero(counts)
        out[full] = mixed(np.add.reduceat(weighed, off[:-1][full])) | np.uint64(1)
    return out


def measure(docs: DataFrame, text: str = "text", min_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """The rows of ``docs`` with the measures of their whole texts and the hashes of their lines."""
    added = set(MEASURES.names)
    docs = docs.select([c for c in docs.columns if c not in added])
    schema = T.StructType(docs.schema.fields + MEASURES.fields)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = encoded(batch.column(names.index(text)))
            for a, b in slices([len(x) for x in texts], 1 << 19):
                rows = _measured(texts[a:b], min_words, most_repeated)
                columns = [batch.column(i).slice(a, b - a) for i in range(len(names))]
                columns += [
                    pa.array([r[f.name] for r in rows], _ARROW[f.name]) for f in MEASURES.fields
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *MEASURES.names])

    return docs.mapInArrow(run, schema)


_ARROW = {
    **{n: pa.int64() for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
    "base_failed": pa.bool_(),
    "line_hash": pa.list_(pa.int64()),
    "line_words": pa.list_(pa.int32()),
}


def boilerplate(
    measured: DataFrame, texts: DataFrame, host: str, max_docs: int
) -> DataFrame:
    """(host, line) of the lines above the limit that do not belong to copies of a few texts.

    ``measured`` has columns ``_doc`` (64-bit hash of the document) and ``_row``; ``texts``: the whole texts as
    (doc, text). Documents are counted by map-side sums; only documents with a frequent line in fixed
    surroundings are told apart as texts. A copy in which a neighbour was changed keeps the line's other
    copies together, hence half of them is enough for the surroundings.
    """
    placed = measured.select(
        F.coalesce(F.concat(F.lit("s"), F.col(host).cast("string")), F.lit("n")).alias("host"),
        F.col("_doc").alias("doc"), F.col("_row").alias("row"), F.filter("line_hash", lambda h: h != 0).alias("full"),
    )
    lines = placed.select(
        "host", "doc",
        F.inline(
            F.array_distinct(F.transform(
                "full",
                lambda h, i: F.struct(
                    h.alias("line"),
                    F.when(i > 0, F.get("full", i - 1)).otherwise(F.lit(-1)).alias("before"),
                    F.coalesce(F.get("full", i + 1), F.lit(-1)).alias("after"),
                ),
            ))
        ),
    )
    often = stored(_held_by_more(lines, "doc", max_docs), "often")
    held = stored(lines.join(often, ["host", "line"]).select("host", "line", "doc", "before", "after"), "held")
    dropped(often)
    fixed_side, fixed_line = F.col("most") * 2 >= F.col("all"), F.coalesce(F.col("most_line") * 2 >= F.col("all"), F.lit(False))
    sides = (
        held.select("host", "line", "doc", F.explode(F.array(
            F.struct(F.lit("b").alias("side"), F.col("before").alias("next")),
            F.struct(F.lit("a").alias("side"), F.col("after").alias("next")),
        )).alias("x"))
        .groupBy("host", "line", "x.side", "x.next", "doc").agg(F.lit(1).alias("one"))
        .groupBy("host", "line", "side", "next").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("host", "line", "side").agg(
            F.max("n").alias("most"), F.max(F.when(F.col("next") != -1, F.col("n"))).alias("most_line"), F.sum("n").alias("all"))
        .groupBy("host", "line").agg(
            F.max(F.when(F.col("side") == "b", fixed_side)).alias("fixed_before"),
            F.max(F.when(F.col("side") == "a", fixed_side)).alias("fixed_after"),
            F.max(F.when(F.col("side") == "b", fixed_line)).alias("line_before"),
            F.max(F.when(F.col("side") == "a", fixed_line)).alias("line_after"))
    )
    sides = stored(sides, "sides")
    varied = sides.where("NOT (fixed_before AND fixed_after)").select("host", "line")
    fixed = sides.where("fixed_before AND fixed_after").select("host", "line")
    if fixed.isEmpty():
        dropped(held)
        return varied
    whose = stored(held.join(fixed, ["host", "line"]).select("host", "line", "doc").distinct(), "whose")
    dropped(held)
    holders = whose.select("doc").distinct()
    said = stored(_said(placed.join(holders, "doc", "left_semi"), sides), "said")
    silent = holders.join(said, "doc", "left_anti")
    named = neardup.named(texts, "doc", "text", among=silent)
    told = said.unionByName(named.select("doc", F.xxhash64(F.lit("copies of"), "component_id").alias("said")))
    apart = _held_by_more(whose.join(told, "doc"), "said", max_docs)
    found = stored(varied.unionByName(apart), "boilerplate")
    dropped(whose, sides, said)
    return found


def _said(placed: DataFrame, sides: DataFrame) -> DataFrame:
    """(doc, said): hash of what a document says beside frequent lines and edits of them; no row if nothing.

    A window holds the lines of one row of the input.
    """
    each = placed.select("host", "doc", "row", F.posexplode("full").alias("place", "line"))
    each = each.join(sides, ["host", "line"], "left")
    down, up = Window.partitionBy("row").orderBy("place"), Window.partitionBy("row").orderBy(F.desc("place"))
    own = (
        each.withColumn("above", F.last("line_after", True).over(down))
        .withColumn("below", F.last("line_before", True).over(up))
        .where("fixed_before IS NULL AND NOT coalesce(above, false) AND NOT coalesce(below, false)")
    )
    total = F.sum(F.col("line").cast("decimal(20,0)"))
    return (
        own.groupBy("row", "doc").agg(F.xxhash64(F.lit("says"), total, F.count(F.lit(1))).alias("said"))
        .groupBy("doc").agg(F.min("said").alias("said"))
    )


def _held_by_more(lines: DataFrame, by: str, limit: int) -> DataFrame:
    """(host, line) with more than ``limit`` distinct values of ``by``."""
    return (
        lines.groupBy("host", "line", by).agg(F.lit(1).alias("one"))
        .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("host", "line")
    )


def judge(
    docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id", min_words: int = 50,
    most_repeated: int = 50, max_docs: int = 10, least_words: int = 25, least_share: float = 0.3,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``carry``) with measures, ``removed_lines`` (places of removed lines), ``left_words`` and ``kept``.

    ``max_docs``: different texts of a host that may share a line. Depleted: fewer than ``least_words``
    words or less than ``least_share`` of the words are left.
    """
    spark = docs.sparkSession
    added = {"_row", "_host", "_doc", "removed_lines", "left_words", "kept", *MEASURES.names}
    docs = docs.select([c for c in docs.columns if c not in added])
    key = F.when(F.col(doc_id).isNull(), F.xxhash64(F.lit("text"), text)).otherwise(F.xxhash64(doc_id))
    rows = docs.select(
        *docs.columns, F.col(host).alias("_host"), key.alias("_doc"), F.monotonically_increasing_id().alias("_row")
    )
    measured = measure(rows, text, min_words, most_repeated)
    if carry is not None:
        measured = measured.select(*carry, "_host", "_doc", "_row", *MEASURES.names)
    measured = stored(measured, "measured")
    texts = docs.select(key.alias("doc"), F.col(text).alias("text"))
    bad = boilerplate(measured, texts, "_host", max_docs)
    lines = measured.select(
        "_row",
        F.coalesce(F.concat(F.lit("s"), F.col("_host").cast("string")), F.lit("n")).alias("host"),
        F.posexplode(F.arrays_zip("line_hash", "line_words")).alias("place", "at"),
    ).select("_row", "host", "place", F.col("at.line_hash").alias("line"), F.col("at.line_words").alias("n"))
    gone = (
        lines.where("line <> 0").join(bad, ["host", "line"])
        .groupBy("_row").agg(F.sum("n").alias("_gone"), F.array_sort(F.collect_list("place")).alias("removed_lines"))
    )
    left = F.col("n_words") - F.coalesce("_gone", F.lit(0))
    depleted = (left < F.col("n_words")) & ((left < least_words) | (left < least_share * F.col("n_words")))
    return (
        measured.drop("line_hash", "line_words").join(gone, "_row", "left")
        .withColumn("left_words", left)
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .drop("_gone", "_row", "_host", "_doc")
    )


def cleaned(judged: DataFrame, text: str = "text") -> DataFrame:
    """The kept documents without their removed lines."""
    lines = F.split(F.col(text), "\n", -1)
    left = F.filter(lines, lambda x, i: ~F.array_contains("removed_lines", i))
    new = F.when(F.col("removed_lines").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return judged.where("kept").withColumn(text, new)
