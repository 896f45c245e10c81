"""Exact duplicates: a two-pass Bloom filter picks the rows that may have a copy, only those shuffle.

Texts are equal when they agree after every character of ``[\\x20\\x09-\\x0D]`` is deleted; the SHA-256 of
what is left stands for the text. Of equal texts the row with the most code points stays, then the
smallest doc_id (null last), then any one of the repeated rows.

1. One map-only pass writes a skinny row per document: digest, length, doc_id and what the caller carries.
2. First pass of the filter: every digest sets a slot in each of ``HASHES`` tables. Slots are counted
   with map-side sums, and those hit twice or more become bitmaps of 4 KB.
3. Second pass: a row all of whose slots were hit twice may have a copy, any other row has none and
   goes straight to the result. Such rows alone are grouped by their digest.

The filter is cut by digest into slices of ``SLICE`` documents, so what is broadcast never exceeds
``SLICE * BITS * HASHES / 8`` bytes of bitmaps (64 MB), however large the corpus is. The skinny rows
are sorted by digest inside their files, so a slice reads its own row groups and pages.

A group of copies may hold any share of the rows: it is summed up map-side, and groups of more than
``HOT`` rows or a 100,000th of all rows, of which there are at most 100,000, are broadcast back to
their rows, so no task receives a whole hot group.

Null text counts as empty, and all empty texts are equal. Repeated rows are rows of their own. An empty
table gives an empty result. Columns of the input named like the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomart.llm.stages import dropped, stored
from foliomart.session import discard, scratch_path

#: Documents a slice of the filter is made for, its bits per document and table, and its tables.
SLICE = 1 << 25
BITS = 8
HASHES = 2
HOT = 64
MOST_HOT = 100_000
GAPS = "[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAPS, "")


def _slots(digest: Column, bits: int) -> list[Column]:
    """A slot per table, from hashes that are independent of the slice."""
    return [F.pmod(F.xxhash64(digest, F.lit(i + 1)), F.lit(bits)) for i in range(HASHES)]


def _repeated_slots(rows: DataFrame, bits: int) -> DataFrame:
    """(table, bucket, map): the bitmaps of all slots that two or more rows set."""
    slots = F.array(*[F.struct(F.lit(i).alias("table"), s.alias("slot")) for i, s in enumerate(_slots(F.col("digest"), bits))])
    hits = rows.select(F.explode(slots).alias("s")).select("s.*").groupBy("table", "slot").count()
    return (
        hits.where("count > 1")
        .groupBy("table", F.expr("bitmap_bucket_number(slot)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("map"))
    )


def _is_set(bitmap: Column, position: Column) -> Column:
    """Whether a bit of a bitmap is set: bit p is bit p mod 8 of byte p div 8. Where there is no bitmap, none is."""
    byte = F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("long")
    return F.coalesce(F.getbit(value, F.pmod(position, F.lit(8)).cast("int")) == 1, F.lit(False))


def _marked(rows: DataFrame, bits: int) -> DataFrame:
    """The rows of a slice with ``again``: whether another row may hold the same digest."""
    maps = stored(_repeated_slots(rows, bits), "repeated-slots")
    again = F.lit(True)
    for i, slot in enumerate(_slots(F.col("digest"), bits)):
        of = maps.where(F.col("table") == i).select(F.col("bucket").alias(f"b{i}"), F.col("map").alias(f"m{i}"))
        rows = rows.withColumn(f"s{i}", slot)
        rows = rows.join(F.broadcast(of), F.expr(f"bitmap_bucket_number(s{i}) = b{i}"), "left")
        again = again & _is_set(F.col(f"m{i}"), F.expr(f"bitmap_bit_position(s{i})"))
    marked = stored(rows.select("doc_id", "n_chars", "digest", "row", "carried", again.alias("again")), "marked")
    dropped(maps)
    return marked


def mark(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), slice_docs: int = SLICE,
    hot: int = HOT,
) -> DataFrame:
    """Per row: doc_id, keep_id (of the row that stays), group_size, kept, text_sha256; ``carried`` holds the columns in ``keep``."""
    body = normalised(F.col(text))
    digest = F.unhex(F.sha2(body.cast("binary"), 256))
    carried = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(None).cast("int")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars"),
        digest.alias("digest"), F.monotonically_increasing_id().alias("row"), carried.alias("carried"),
    )
    rows = rows.withColumn("cut", F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"))
    rows = stored(rows.sortWithinPartitions("cut"), "digests")
    n = rows.count()
    slices = max(1, -(-n // slice_docs))
    # a power of two, so every bitmap is full-sized
    bits = 1 << max(15, (min(n, slice_docs) * BITS - 1).bit_length())
    marked = None
    for i in range(slices):
        low, high = (2**32 * i // slices, 2**32 * (i + 1) // slices)
        part = _marked(rows.where((F.col("cut") >= low) & (F.col("cut") < high)), bits)
        marked = part if marked is None else marked.unionByName(part)
    dropped(rows)
    maybe = marked.where("again")
    best = F.min(F.struct((-F.col("n_chars")).alias("short"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("best")
    groups = stored(maybe.groupBy("digest").agg(F.count("*").alias("size"), best).where("size > 1"), "copies")
    groups = groups.select("digest", "size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    large = max(hot, n // MOST_HOT)
    met = maybe.join(F.broadcast(groups.where(F.col("size") > large)), "digest", "left")
    rest = met.where("size IS NULL").drop("size", "keep_id", "keep_row")
    rest = rest.join(groups.where(F.col("size") <= large), "digest", "left")
    known = met.where("size IS NOT NULL").unionByName(rest)
    alone = marked.where("NOT again")
    for name, kind in (("size", "long"), ("keep_id", docs.schema[doc_id].dataType), ("keep_row", "long")):
        alone = alone.withColumn(name, F.lit(None).cast(kind))
    single = F.col("size").isNull()
    return known.unionByName(alone).select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "carried",
    )


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of equal texts, with the columns of ``docs``."""
    return mark(docs, keep=tuple(docs.columns), **options).where("kept").select("carried.*")
