"""Vectorized words, windows and hashes of a batch of texts.

Arrow hands a batch of texts over as one byte buffer with offsets. Everything here works
on that buffer with numpy: no Python loop over texts, words or characters. Null texts
count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_MASK16 = 0xFFFF


def _random64(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


BYTE_CODES = _random64(256, 11)
PLACE_CODES = _random64(1 << 16, 12)
FAR_CODES = _random64(1 << 16, 13)


def byte_class(ranges: list[tuple[int, int]]) -> np.ndarray:
    """A table of 256 truth values, true in the given inclusive ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: bytes of words `[^\x20\x09-\x0D]+`
PLAIN = ~byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z became a-z
ALNUM = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffer_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows (one more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` text bytes; a longer text stands alone."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)


def sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` in each segment of consecutive offsets."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offs[1:]] - total[offs[:-1]]


class Runs:
    """Maximal runs of bytes of a class, none across the end of a text.

    starts, ends: byte positions; counts: runs of each text; first: index of each text's
    first run (one more than texts); row: the text of each run.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, table: np.ndarray):
        self.data, self.offs = data, offs
        inside = table[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offs] = True
        before = np.concatenate(([False], inside[:-1])) if len(data) else inside
        after = np.concatenate((inside[1:], [False])) if len(data) else inside
        self.inside = inside
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offs)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offs) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, translate: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each run's bytes."""
        if not len(self):
            return np.zeros(0, np.uint64)
        inner = self.data[self.inside]
        if translate is not None:
            inner = translate[inner]
        lengths = self.ends - self.starts
        begin = np.cumsum(lengths) - lengths
        place = np.arange(len(inner)) - np.repeat(begin, lengths)
        value = BYTE_CODES[inner] * PLACE_CODES[place & _MASK16]
        if lengths.max() > _MASK16:
            value *= FAR_CODES[(place >> 16) & _MASK16]
        return mix(np.add.reduceat(value, begin) + lengths.astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` hashes from each position on; valid where so many follow.

    Windows are joined from windows of powers of two, so the work grows with the
    logarithm of the width.
    """
    n = len(words)
    if n < width:
        return np.zeros(0, np.uint64)
    power, size, out, done = words, 1, None, 0
    left = width
    while True:
        if left & 1:
            part = power[done : done + n - width + 1]
            out = part if out is None else mix(out * np.uint64(0x9E3779B97F4A7C15) + part)
            done += size
        left >>= 1
        if not left:
            return out
        power = mix(power[: len(power) - size] * np.uint64(0xD6E8FEB86659FD93) + power[size:])
        size *= 2


def window_starts(runs: Runs, width: int) -> np.ndarray:
    """Indexes of the runs at which a window of ``width`` runs of one text starts."""
    n = len(runs)
    if n < width:
        return np.zeros(0, np.int64)
    last = np.repeat(runs.first[1:], runs.counts)
    index = np.arange(n)
    return index[index + width <= last]


def covered(starts: np.ndarray, width: int | np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window that starts at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:-1]) > 0


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts ``key``, and where a new value begins in that order."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    return order, new
