"""Text columns as NumPy arrays: bytes, words and shingles of a whole Arrow batch at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multipliers of the mixing steps (any odd numbers with well-spread bits do).
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, in place where ``x`` owns its memory."""
    x = x ^ (x >> np.uint64(32))
    x *= MIX_B
    x ^= x >> np.uint64(29)
    x *= MIX_A
    x ^= x >> np.uint64(32)
    return x


def bytes_of(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, joined, and the offsets of its rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    joined = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    base = offsets[0] if len(offsets) else 0
    return joined[base : offsets[-1]] if len(offsets) else joined[:0], offsets - base


def slices_by_bytes(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(sizes):
        return
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, joined."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - firsts, lengths)
