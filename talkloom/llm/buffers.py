"""Texts of an Arrow column as one byte array, so that work on bytes, words and lines needs no loop over rows.

Words are runs of bytes other than U+0020 and U+0009 to U+000D unless another byte class is given; they never cross texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that one step of the work holds; every temporary array is a small multiple of it. A longer text makes its own step.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True
#: ASCII capitals in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Texts:
    """data[starts[i]:ends[i]] are the bytes of row first + i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: int = 0

    def __len__(self) -> int:
        return len(self.starts)


@dataclass
class Runs:
    """Byte ranges and the row, counted within the chunk, that each lies in."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray


def from_arrow(column: pa.Array | pa.ChunkedArray) -> Texts:
    """Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if n == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return Texts(data[at[0] : at[-1]], at[:-1] - at[0], at[1:] - at[0])


def chunks(texts: Texts, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Consecutive whole texts of about limit bytes together."""
    row, n = 0, len(texts)
    while row < n:
        low = texts.starts[row]
        stop = max(row + 1, int(np.searchsorted(texts.ends, low + limit, "right")))
        yield Texts(texts.data[low : texts.ends[stop - 1]], texts.starts[row:stop] - low, texts.ends[row:stop] - low, row)
        row = stop


def runs(texts: Texts, inside: np.ndarray) -> Runs:
    """Maximal runs of bytes of a class (256 flags) within each text."""
    member = inside[texts.data]
    filled = texts.starts < texts.ends
    begins, stops = member.copy(), member.copy()
    begins[1:] &= ~member[:-1]
    stops[:-1] &= ~member[1:]
    low, high = texts.starts[filled], texts.ends[filled] - 1
    begins[low] = member[low]
    stops[high] = member[high]
    starts = np.flatnonzero(begins)
    rows = np.flatnonzero(filled)[np.searchsorted(low, starts, "right") - 1] if len(low) else starts
    return Runs(starts, np.flatnonzero(stops) + 1, rows)


def words(texts: Texts) -> Runs:
    return runs(texts, ~SPACES)


class Hasher:
    """64-bit hashes of any byte ranges of one buffer, at a few operations a byte and a few a range."""

    _powers = _inverse = np.zeros(0, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(Hasher._powers) < n:
            room = max(n, CHUNK_BYTES + 1)
            Hasher._powers, Hasher._inverse = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(room, x)])) for x in (_BASE, _BASE_INVERSE))
        self._sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * Hasher._powers[: n - 1], out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * Hasher._inverse[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def code_points(data: np.ndarray) -> np.ndarray:
    """Code points before each byte offset, the end included."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out
