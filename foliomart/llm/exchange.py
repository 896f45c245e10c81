"""How often 64-bit keys occur over all blocks, asked and answered in packed form.

A block is a row with a number and a payload. Each block asks about its distinct keys once: a bucket
gets one row with the sorted low halves of its keys and their weights. The bucket adds up and answers
each block in the order asked. A hot key thus costs one entry per block, however often it occurs, and
a bucket holds a bounded number of entries because buckets are added in proportion to the entries.

Within a bucket keys are told apart by 32 bits. Two different keys may therefore share a count, which
can only make it larger: callers use the counts to rule work out and settle the rest exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ENTRIES = 1_500_000
#: Set in a weight: the block alone has two documents that share the key.
SHARED = np.uint16(1 << 15)
LEVEL = 6
_ASK = "bucket int, block long, keys binary, weights binary"
_ANSWER = "block long, bucket int, counts binary"


def packed(*parts) -> bytes:
    """Arrays or bytes one after another, compressed."""
    return zstandard.ZstdCompressor(LEVEL).compress(b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts))


def unpacked(body: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(body)


def buckets_for(spark, entries: int) -> int:
    """As many buckets as keep each near ENTRIES, and enough to use the cluster."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(entries) // ENTRIES))


def split(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys by bucket and low half, the buckets' ends in it, the low halves in it."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    low = keys & np.uint64(0xFFFFFFFF)
    order = np.argsort((bucket << np.uint64(32)) | low, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(n + 1, dtype=np.uint64))
    return order, ends, low[order].astype(np.uint32)


def ask(blocks: DataFrame, keys_of: Callable, n: int) -> DataFrame:
    """``keys_of(payload)`` gives distinct keys and weights (up to 65535) of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys, weights = keys_of(payload.as_buffer())
                order, ends, low = split(keys, n)
                weights = np.minimum(weights, 65535).astype(np.uint16)[order]
                full = [b for b in range(n) if ends[b] < ends[b + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full, pa.int32()),
                        pa.array([block] * len(full), pa.int64()),
                        pa.array([low[ends[b] : ends[b + 1]].tobytes() for b in full], pa.binary()),
                        pa.array([weights[ends[b] : ends[b + 1]].tobytes() for b in full], pa.binary()),
                    ],
                    names=["bucket", "block", "keys", "weights"],
                )

    return blocks.select("block", "payload").mapInArrow(run, _ASK)


def answer(asked: DataFrame, flagged: bool = False) -> DataFrame:
    """The summed weight of each key (up to 2**32 - 1), in the order asked.

    ``flagged``: weights are up to 32767 and may carry ``SHARED``. A key that neither does nor stands in
    two blocks is answered with 0.
    """

    def run(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x.as_buffer(), np.uint32) for x in table["keys"]]
        flat = np.concatenate(keys)
        weights = np.concatenate([np.frombuffer(x.as_buffer(), np.uint16) for x in table["weights"]])
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        first = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        weights = weights[order]
        own = weights & ~SHARED if flagged else weights
        sums = np.add.reduceat(own.astype(np.uint64), np.flatnonzero(first))
        if flagged:
            holders = np.add.reduceat(1 + (weights >= SHARED).astype(np.int64), np.flatnonzero(first))
            sums[holders < 2] = 0
        counts = np.empty(len(flat), np.uint32)
        counts[order] = np.minimum(sums, 2**32 - 1)[np.cumsum(first) - 1].astype(np.uint32)
        ends = np.cumsum([len(k) for k in keys])[:-1]
        return pa.table(
            {
                "block": table["block"],
                "bucket": table["bucket"],
                "counts": pa.array([packed(c) for c in np.split(counts, ends)], pa.binary()),
            }
        )

    return asked.groupBy("bucket").applyInArrow(run, _ANSWER)


def answered(table: pa.Table, keys: np.ndarray, n: int) -> np.ndarray:
    """Put a block's answers back into the order of its keys."""
    order, ends, _ = split(keys, n)
    counts = np.zeros(len(keys), np.uint32)
    for bucket, got in zip(table["bucket"].to_pylist(), table["counts"]):
        counts[order[ends[bucket] : ends[bucket + 1]]] = np.frombuffer(unpacked(got.as_py()), np.uint32)
    return counts


def numbered(df: DataFrame, name: str = "block") -> DataFrame:
    return df.withColumn(name, F.monotonically_increasing_id())
