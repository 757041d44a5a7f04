"""Texts of an Arrow batch as NumPy arrays: words, their 64-bit codes, and bounded chunks.

A string column is already one byte buffer plus offsets, so words and codes of thousands of texts are
found by a few array operations instead of a Python loop. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit codes (the finaliser of splitmix64)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_BASE = 0xD1342543DE82EF95
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the next chunk; a copy starts empty."""

    def __init__(self):
        self.kept: dict[int, np.ndarray] = {}

    def __reduce__(self):
        return _Powers, ()

    def __call__(self, base: int, n: int) -> np.ndarray:
        have = self.kept.get(base)
        if have is None or len(have) < n:
            steps = np.full(max(n, CHUNK_BYTES // 4), base, np.uint64)
            steps[0] = 1
            have = self.kept[base] = np.multiply.accumulate(steps)
        return have[:n]


powers = _Powers()


def prefix_codes(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of the bytes: any span's code follows from two of them."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_CODES[data] * powers(_BASE, len(data)), out=sums[1:])
    return sums


def span_codes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit codes of byte spans; equal contents have equal codes wherever they stand."""
    raw = (sums[ends] - sums[starts]) * powers(_BASE_INVERSE, len(sums))[starts]
    return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(_ODD))


def sequence_codes(codes: np.ndarray, length: int) -> np.ndarray:
    """Codes of every run of ``length`` consecutive codes (len(codes) - length + 1 of them)."""
    n = max(0, len(codes) - length + 1)
    out = np.full(n, length, np.uint64)
    for k in range(length):
        out = mixed(out * np.uint64(_ODD) + codes[k : k + n])
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    wide = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.cast(wide)
    if column.null_count:
        column = column.fill_null(b"" if wide == pa.large_binary() else "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    base, end = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(data, np.uint8)[base:end] if data is not None and end > base else np.empty(0, np.uint8)
    return data, offsets - base


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer text is a range of its own, never cut."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(rows, max(stop, start + 1))
        yield start, stop
        start = stop


#: Byte tables: A-Z to lower case, and the bytes that part words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


@dataclass
class Words:
    """The words of some texts: byte spans, 64-bit codes, each text's range of words, and the running sums of the bytes."""

    starts: np.ndarray
    ends: np.ndarray
    codes: np.ndarray
    bounds: np.ndarray
    sums: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


AS_IS = np.arange(256, dtype=np.uint8)


def words_of(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, letters: np.ndarray = LOWER) -> Words:
    """Words of each text after its bytes went through ``letters``; ``separators`` marks the (mapped) bytes between words."""
    lower = letters[data]
    inside = ~separators[lower]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    first = offsets[:-1][np.diff(offsets) > 0]
    starts[first] = inside[first]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    ends[last] = inside[last]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    sums = prefix_codes(lower)
    return Words(starts, ends, span_codes(sums, starts, ends), np.searchsorted(starts, offsets), sums)


def inserted(known: np.ndarray, order: np.ndarray, codes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising codes with their places after rising new ones came in."""
    at = np.searchsorted(known, codes)
    return np.insert(known, at, codes), np.insert(order, at, places)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, .. for each (start, length), one after the other."""
    total = int(lengths.sum())
    shifts = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) if len(starts) else np.empty(0, np.int64)
    return np.arange(total) + shifts


def list_array(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    """A list column whose row i holds values[bounds[i]:bounds[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch plus columns; a new one replaces an old one of the same name."""
    names = [n for n in batch.schema.names if n not in new]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *new.values()], names=[*names, *new])
