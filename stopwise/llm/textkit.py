"""Vectorised work on the texts of an Arrow batch: words, hashes, windows.

Texts are taken as their UTF-8 bytes in one array. A batch is handled in
chunks of bounded size, so memory depends on the longest text, not on the batch.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20


def let_go() -> None:
    """Give freed memory back to the system, as workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has this
        ctypes.CDLL("libc.so.6").malloc_trim(0)


_U64 = np.uint64


def _odd(seed: int) -> int:
    return (seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64) | 1


class Powers:
    """Powers of an odd multiplier modulo 2**64, and of its inverse, as far as asked for."""

    def __init__(self, seed: int) -> None:
        self._base = (_odd(seed), pow(_odd(seed), -1, 1 << 64))
        self._kept = [np.ones(1, _U64), np.ones(1, _U64)]

    def _upto(self, which: int, count: int) -> np.ndarray:
        have = self._kept[which]
        while len(have) < count:
            step = _U64(pow(self._base[which], len(have), 1 << 64))
            have = np.concatenate([have, have * step])
        if len(have) <= 4 * CHUNK_BYTES:
            self._kept[which] = have
        return have[:count]

    def up(self, count: int) -> np.ndarray:
        return self._upto(0, count)

    def down(self, count: int) -> np.ndarray:
        return self._upto(1, count)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = values ^ (values >> _U64(30))
    values *= _U64(0xBF58476D1CE4E5B9)
    values ^= values >> _U64(27)
    values *= _U64(0x94D049BB133111EB)
    values ^= values >> _U64(31)
    return values


class Hasher:
    """Polynomial (Rabin-Karp) hashes of byte ranges and of runs of values."""

    def __init__(self, seed: int) -> None:
        self._bytes = Powers(2 * seed)
        self._items = Powers(2 * seed + 1)
        self._table = mix(np.arange(1, 257, dtype=_U64) * _U64(_odd(seed + 77)))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        sums = np.empty(len(data) + 1, _U64)
        sums[0] = 0
        np.cumsum(self._table[data] * self._bytes.up(len(data)), out=sums[1:])
        return sums

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of each byte range; equal ranges hash alike wherever they stand."""
        sums = self.prefix(data)
        return mix((sums[ends] - sums[starts]) * self._bytes.down(len(data) + 1)[starts])

    def grams(self, data: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes from each place on."""
        if len(data) < size:
            return np.empty(0, _U64)
        sums = self.prefix(data)
        count = len(data) - size + 1
        return mix((sums[size:] - sums[:count]) * self._bytes.down(count))

    def runs(self, values: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` consecutive values from each place on."""
        if len(values) < size:
            return np.empty(0, _U64)
        sums = np.empty(len(values) + 1, _U64)
        sums[0] = 0
        np.cumsum(values * self._items.up(len(values)), out=sums[1:])
        count = len(values) - size + 1
        return mix((sums[size:] - sums[:count]) * self._items.down(count))

    def whole(self, values: np.ndarray) -> int:
        """Hash of all values as one run."""
        return int(self.runs(values, len(values))[0]) if len(values) else 0


@dataclass
class Chunk:
    """Some rows of a batch: bytes of all texts, and where each row's text lies."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def _plain_binary(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array | pa.ChunkedArray, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column into chunks of whole texts; null counts as empty."""
    if not len(column):
        return
    data, offsets = _plain_binary(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(column))
        low, high = int(offsets[first]), int(offsets[last])
        yield Chunk(first, data[low:high], offsets[first : last + 1] - low)
        first = last


# Bytes that end a word: ASCII white space.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
NOT_SPACE = ~SPACES

# Bytes of words that are only digits, small letters and all that is not ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Words:
    """Words of a chunk in text order: byte spans, and the row each belongs to."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    first: np.ndarray  # by row: its first word's number; one more at the end

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def places(self) -> np.ndarray:
        """Number of each word within its text."""
        return np.arange(len(self)) - self.first[self.rows]

    def whole_runs(self, size: int) -> np.ndarray:
        """Whether the ``size`` words from each word on are of one text."""
        count = max(0, len(self) - size + 1)
        return self.rows[:count] == self.rows[size - 1 :][:count]


def words(chunk: Chunk, kept: np.ndarray) -> Words:
    """Maximal runs of the kept bytes, never across texts."""
    inside = kept[chunk.data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    edges = chunk.offsets[(chunk.offsets > 0) & (chunk.offsets < len(inside))]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(end) + 1
    first = np.searchsorted(starts, chunk.offsets)
    rows = np.repeat(np.arange(len(chunk)), np.diff(first))
    return Words(starts, ends, rows, first)


def spans_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Byte ranges as an Arrow binary array (the ranges must not overlap)."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    place = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[place])]
    )


def binary_array(pieces: list[bytes]) -> pa.Array:
    return pa.array(pieces, pa.binary())


def covered(starts: np.ndarray, size: int, length: int) -> np.ndarray:
    """Which of ``length`` places lie in a window of ``size`` that begins at a start."""
    change = np.zeros(length + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, length), -1)
    return np.cumsum(change[:-1]) > 0
