"""Arrays of a batch as short binaries, and sorted 128-bit keys."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)


def _squeezed(data: bytes | pa.Buffer) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _whole(data: bytes) -> bytes:
    return pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def packed_numbers(numbers: np.ndarray) -> bytes:
    """Whole numbers; their first bytes are put together, their second ones, and so on."""
    numbers = np.ascontiguousarray(numbers, np.int64)
    width = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8)) if numbers.min(initial=0) >= 0 else 8
    planes = numbers.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + _squeezed(planes.tobytes())


def unpacked_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_whole(data[1:]), np.uint8).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.reshape(-1).view(np.int64)


def packed_words(words: pa.Array) -> bytes:
    """Texts that are neither empty nor hold a space."""
    listed = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return _squeezed(pc.binary_join(listed, " ")[0].as_buffer())


def unpacked_words(data: bytes) -> pa.Array:
    text = _whole(data).decode()
    return pc.split_pattern(pa.array([text]), " ").flatten() if text else pa.array([], pa.string())


def packed_rows(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked_rows(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def part_of(h1: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges of first halves a key is in: growing with the first half."""
    return (((h1 >> _HALF) * np.uint64(parts)) >> _HALF).astype(np.int64)


def sorted_keys(h1: np.ndarray, h2: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and which of them, so ordered, are the first of their kind. Without groups the
    order is that of the first halves; keys of different groups are different."""
    first = h1 if group is None else h1 + group.astype(np.uint64) * _ODD
    rest = [h2] if group is None else [h2, group]
    order = np.argsort(first)
    for again in (False, True):
        if again:  # two keys share a first half: equal keys may lie apart
            order = np.lexsort([*rest, first])
        a = first[order]
        same = a[1:] == a[:-1]
        other = np.zeros_like(same)
        for x in rest:
            x = x[order]
            other |= x[1:] != x[:-1]
        if not (same & other).any():
            break
    return order, np.concatenate([np.ones(min(len(a), 1), bool), ~same | other])


def found_at(h1: np.ndarray, h2: np.ndarray, q1: np.ndarray, q2: np.ndarray) -> np.ndarray:
    """Where the keys ``q1, q2`` are among keys ordered by their first halves, -1 for those that are not."""
    if not len(h1):
        return np.full(len(q1), -1)
    at, out = np.searchsorted(h1, q1), np.full(len(q1), -1)
    left = np.flatnonzero(at < len(h1))
    while len(left):
        left = left[h1[at[left]] == q1[left]]
        hit = h2[at[left]] == q2[left]
        out[left[hit]] = at[left[hit]]
        left = left[~hit]
        at[left] += 1
        left = left[at[left] < len(h1)]
    return out


def split_by(values: np.ndarray) -> Sequence[tuple[int, int, int]]:
    """(value, from, to) of each run of equal values."""
    if not len(values):
        return []
    edges = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return [(int(values[a]), a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
