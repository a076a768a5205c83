"""Small helpers for functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

#: what a function holds unpacked at once, in characters or tokens
PIECE = 1 << 20


def pieces(batch: pa.RecordBatch | pa.Array, sizes: np.ndarray, most: int | None = None) -> Iterator[pa.RecordBatch | pa.Array]:
    """Consecutive slices of about ``most`` units, ``PIECE`` if not given, of which row i has ``sizes[i]``. A
    row stays whole."""
    most = most or PIECE
    starts = np.cumsum(sizes) - sizes
    edges = np.flatnonzero(np.diff(starts // most)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(sizes)], strict=True):
        if high > low:
            yield batch.slice(low, high - low)


def groups_of(batch: pa.RecordBatch, by: Sequence[str]) -> tuple[np.ndarray, pa.Array]:
    """The number of each row's group, and a row of each group."""
    seen: dict[tuple, int] = {}
    keys = zip(*(batch.column(c).to_pylist() for c in by), strict=True) if by else [()] * batch.num_rows
    numbers = np.array([seen.setdefault(k, len(seen)) for k in keys], np.int64)
    return numbers, pa.array(np.unique(numbers, return_index=True)[1])
