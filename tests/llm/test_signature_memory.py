"""Signatures of a batch are made in slices that leave an executor's memory to its other tasks."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from tablewright.llm import near_dups
from tablewright.llm.textkit import slices


def test_signatures_hold_little_at_once():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(4500)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    tracemalloc.start()
    for piece in slices(batch, "text", near_dups.SIGN_BYTES):
        row, items, counts = near_dups.shingles(piece.column("text"))
        near_dups.signatures(row, items, counts.astype(np.float64), piece.num_rows, near_dups.ROWS * near_dups.BANDS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20, peak
