"""Seeded draws for all replicates of a batch of rows, folded into sums by replicate.

A draw is the first 32 bits of MD5 of ``seed:replicate:row_id``. The messages of a batch and all
replicates are hashed together, one numpy operation for each step of MD5, and only the
sums by replicate leave a task: one array per group and task, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.sized import task_count

LANES = 1 << 14
HELD_GROUPS = 2_000
BLOCK = 64

# The shifts of the four rounds of MD5 and its first state.
SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
STATE = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]


def _first_word(words: np.ndarray) -> np.ndarray:
    """The first four bytes of the digest, as a big-endian number, of messages of one block;
    words has the 16 words of each message in its rows."""
    a, b, c, d = (np.full(words.shape[1], s, np.uint32) for s in STATE)
    for i in range(64):
        turn, step = divmod(i, 16)
        if turn == 0:
            mixed, at = d ^ (b & (c ^ d)), step
        elif turn == 1:
            mixed, at = c ^ (d & (b ^ c)), (5 * step + 1) % 16
        elif turn == 2:
            mixed, at = b ^ c ^ d, (3 * step + 5) % 16
        else:
            mixed, at = c ^ (b | ~d), 7 * step % 16
        mixed += a
        mixed += np.uint32(SINES[i])
        mixed += words[at]
        left = SHIFTS[turn][i % 4]
        turned = (mixed << np.uint32(left)) | (mixed >> np.uint32(32 - left))
        turned += b
        a, d, c, b = d, c, b, turned
    return (a + np.uint32(STATE[0])).byteswap()


def draws(ids: Sequence[str], samples: int, seed: int) -> np.ndarray:
    """A 32-bit number for every id and replicate from 1 on, [id, replicate]."""
    out = np.empty((len(ids), samples), np.uint32)
    raw = [x.encode() for x in ids]
    lengths = np.array([len(x) for x in raw])
    # replicates with as many digits have prefixes of one length
    spans = [(10**k, min(10 ** (k + 1), samples + 1)) for k in range(len(str(samples)))]
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        tails = np.frombuffer(b"".join(raw[i] for i in rows), np.uint8).reshape(len(rows), n)
        for low, high in spans:
            heads = [f"{seed}:{r}:".encode() for r in range(low, high)]
            size = len(heads[0]) + n
            if size > BLOCK - 9:
                for i in rows:
                    out[i, low - 1 : high - 1] = [int.from_bytes(hashlib.md5(h + raw[i]).digest()[:4]) for h in heads]
                continue
            front = np.frombuffer(b"".join(heads), np.uint8).reshape(len(heads), -1)
            each = max(1, LANES // len(heads))
            for start in range(0, len(rows), each):
                part = tails[start : start + each]
                text = np.zeros((len(part), len(heads), BLOCK), np.uint8)
                text[:, :, : front.shape[1]] = front
                text[:, :, front.shape[1] : size] = part[:, None, :]
                text[:, :, size] = 0x80
                text[:, :, 56:58] = np.frombuffer(int(8 * size).to_bytes(2, "little"), np.uint8)
                words = np.ascontiguousarray(text.reshape(-1, BLOCK).view("<u4").T)
                out[rows[start : start + each], low - 1 : high - 1] = _first_word(words).reshape(len(part), len(heads))
    return out


def replicate_sums(
    df: DataFrame, value: str, row_id: str, by: Sequence[str], samples: int, seed: int, weigh: Callable[[np.ndarray], np.ndarray]
) -> DataFrame:
    """The group columns, ``replicate``, ``total`` (weighted sum of the values) and ``weight``.

    ``weigh`` maps draws to the weight of a row in each replicate. A null value adds nothing to the
    total, a row without an id weighs nothing.
    """
    by = list(by)
    rows = df.select(*by, F.col(row_id).cast("string").alias("_id"), F.col(value).cast("double").alias("_value"))
    # each row is much work: they are dealt out, and a given number of tasks is not merged
    rows = rows.repartition(task_count(df), "_id")
    kinds = T.StructType([df.schema[c] for c in by])
    names = [*by, "_totals", "_weights"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        types: list[pa.DataType] = []

        def sums() -> pa.RecordBatch:
            keys = [pa.array([k[i] for k in held], t) for i, t in enumerate(types)]
            both = [pa.array([s[i].tolist() for s in held.values()], pa.list_(pa.float64())) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([*keys, *both], names)

        for batch in batches:
            types = [batch.schema.field(c).type for c in by]
            places: dict[tuple, list[int]] = {}
            keys = zip(*(batch.column(c).to_pylist() for c in by), strict=True) if by else [()] * batch.num_rows
            for i, key in enumerate(keys):
                places.setdefault(key, []).append(i)
            for key, at in places.items():
                if len(held) >= HELD_GROUPS and key not in held:
                    yield sums()
                    held.clear()
                total = held.setdefault(key, np.zeros((2, samples)))
                part = batch.take(pa.array(at)).filter(pa.array(batch.column("_id").take(pa.array(at)).is_valid()))
                numbers = part.column("_value").fill_null(0.0).to_numpy()
                ids = part.column("_id").to_pylist()
                step = max(1, 64 * LANES // samples)
                for start in range(0, len(ids), step):
                    weights = weigh(draws(ids[start : start + step], samples, seed))
                    total[0] += numbers[start : start + step] @ weights
                    total[1] += weights.sum(axis=0)
        if held:
            yield sums()

    schema = T.StructType([*kinds.fields, *(T.StructField(n, T.ArrayType(T.DoubleType())) for n in names[-2:])])
    parts = rows.mapInArrow(fold, schema).select(*by, F.posexplode(F.arrays_zip("_totals", "_weights")).alias("_at", "_s"))
    return (
        parts.groupBy(*by, (F.col("_at") + 1).alias("replicate"))
        .agg(F.sum("_s._totals").alias("total"), F.sum("_s._weights").alias("weight"))
    )


def poisson_counts(bounds: Sequence[float]) -> Callable[[np.ndarray], np.ndarray]:
    """Draws to Poisson counts: how many of the cumulative probabilities are not above them."""
    edges = [math.ceil(b * 2**32) for b in bounds]

    def weigh(drawn: np.ndarray) -> np.ndarray:
        out = np.zeros(drawn.shape)
        for e in edges:
            if e < 2**32:
                out += drawn >= np.uint32(e)
        return out

    return weigh


def signs(drawn: np.ndarray) -> np.ndarray:
    return np.where(drawn < np.uint32(1 << 31), 1.0, -1.0)
