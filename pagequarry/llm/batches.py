"""Texts in Arrow batches as arrays of bytes, words and 64-bit hashes.

Words are found and hashed for a few megabytes of text at a time, so that the memory of a
task follows the longest single text and not the number of rows it was given.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

# The white space that ends a token, and the bytes of a search word.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
TOKEN_BYTES = np.array([b not in SPACE for b in range(256)])
WORD_BYTES = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])

STEP = np.uint64(0x9E3779B97F4A7C15)
STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
PIECE_BYTES = 2 << 20
KEPT_POWERS = (2 << 20) + 1


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def pieces(
    batch: pa.RecordBatch, text: str = "text", most: int = PIECE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``first`` to ``last`` of a batch with at most ``most`` bytes of text (or one row)."""
    data, starts = text_bytes(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(starts, starts[first] + most, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield first, last, data[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
        first = last


def _powers(step: int, size: int) -> np.ndarray:
    powers = np.full(size, step, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


_kept_powers = lru_cache(maxsize=2)(_powers)


def powers(step: np.uint64, size: int) -> np.ndarray:
    """The first powers of ``step`` modulo 2**64. A fixed number of them is kept; those that
    one long text needs beyond are not, as an idle worker would hold them."""
    if size <= KEPT_POWERS:
        return _kept_powers(int(step), KEPT_POWERS)[:size]
    return _powers(int(step), size)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    return x * np.uint64(0xA0761D6478BD642F)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` takes the hash of any span of bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(STEP, len(data)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of bytes ``start`` to ``end``; equal bytes have equal hashes wherever they are."""
    return mix((sums[end] - sums[start]) * powers(STEP_BACK, len(sums))[start])


class Words:
    """Where the words of some texts lie: ``start`` and ``end`` in the bytes, and for
    text t the words ``first[t]`` to ``first[t + 1]``."""

    def __init__(self, data: np.ndarray, texts: np.ndarray, kind: np.ndarray):
        """``data`` is lower-cased already; ``kind`` tells which bytes belong to words."""
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = kind[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[texts] = True
        self.start = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
        self.end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        self.first = np.searchsorted(self.start, texts)
        self.data = data

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        return span_hash(prefix_sums(self.data), self.start, self.end)


def lower(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, every other byte as it was."""
    return np.frombuffer(data.tobytes().translate(LOWER), np.uint8)


def sequence_hash(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of every ``length`` neighbouring words."""
    count = max(0, len(hashes) - length + 1)
    total = np.zeros(count, np.uint64)
    for k in range(length):
        total = total * STEP + hashes[k : k + count]
    return mix(total)


def inside_texts(first: np.ndarray, length: int) -> np.ndarray:
    """Positions of words at which a run of ``length`` stays within its text."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[:-1] - (ends - counts), counts)
