"""Word and shingle hashes of many texts at once, with numpy inside a task.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; both ends of that rule are ASCII, so bytes
and code points agree on where words begin and end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[_GAP] = 0
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
_powers = {"n": 0}


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept per process and grown on demand."""
    if _powers["n"] < n:
        n = max(n, 1 << 19)
        for name, base in (("up", _BASE), ("down", _BACK)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _powers[name] = np.multiply.accumulate(row)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _buffer(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one buffer, its gaps, where words start, and the texts' offsets among the words."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = _LOWER[data]
    gap = _GAP[data]
    starts = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    begins = np.cumsum(lengths) - lengths
    return data, gap, starts, np.append(np.searchsorted(starts, begins), len(starts))


def _hashed(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _grown(len(data))
    return mixed(np.add.reduceat(_BYTE[data] * up[: len(data)], starts) * down[starts])


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the offsets: text i has ``[off[i], off[i+1])``."""
    data, _, starts, offsets = _buffer(texts, lower)
    return _hashed(data, starts), offsets


class Words:
    """Hashes and offsets as `word_hashes`, and the words themselves on demand."""

    def __init__(self, texts: list[bytes]):
        data, gap, self.starts, self.offsets = _buffer(texts, False)
        self.hashes = _hashed(data, self.starts)
        self.ends = np.flatnonzero(gap & np.concatenate(([False], ~gap[:-1])))
        self.raw = data.tobytes()

    def at(self, places: np.ndarray) -> list[bytes]:
        return [self.raw[a:b] for a, b in zip(self.starts[places].tolist(), self.ends[places].tolist())]


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive words."""
    count = max(0, len(words) - n + 1)
    h = np.zeros(count, np.uint64)
    for i in range(n):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xD6E8FEB86659FD93) + words[i : i + count]
    return mixed(h)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; fewer words are one shingle, no words none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(words, min(n, len(words))))


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of at most ``most`` in sum; one larger item is a range of its own."""
    begin, total = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def encoded(column) -> list[bytes]:
    """A string column of an Arrow batch as UTF-8 bytes, null as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
