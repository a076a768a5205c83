"""Arrow-batched helpers for scores that need an alignment of two token lists.

Each call sees the pairs of one batch; rows never depend on each other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.porter import stem


def match_masks(tokens: Sequence[str]) -> dict[str, int]:
    """For every token the positions it takes, as bits of an integer."""
    masks: dict[str, int] = {}
    for i, t in enumerate(tokens):
        masks[t] = masks.get(t, 0) | (1 << i)
    return masks


def lcs_rows(a: Sequence[str], b: Sequence[str]) -> list[int]:
    """Bit-parallel LCS of ``b`` against growing prefixes of ``a``.

    Row i has a zero bit wherever the LCS of a[:i] grows along b.
    """
    masks, full = match_masks(b), (1 << len(b)) - 1
    row, rows = full, []
    rows.append(row)
    for t in a:
        hit = row & masks.get(t, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    return rows


def lcs_length(a: Sequence[str], b: Sequence[str]) -> int:
    if not a or not b:
        return 0
    masks, full = match_masks(b), (1 << len(b)) - 1
    row = full
    for t in a:
        hit = row & masks.get(t, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(b) - row.bit_count()


def lcs_positions(reference: Sequence[str], candidate: Sequence[str]) -> set[int]:
    """Positions of ``reference`` on one longest common subsequence."""
    if not reference or not candidate:
        return set()
    rows = lcs_rows(reference, candidate)

    def size(i: int, j: int) -> int:
        return j - (rows[i] & ((1 << j) - 1)).bit_count()

    i, j, found = len(reference), len(candidate), set()
    while i and j:
        if reference[i - 1] == candidate[j - 1]:
            i, j = i - 1, j - 1
            found.add(i)
        elif size(i, j - 1) > size(i - 1, j):
            j -= 1
        else:
            i -= 1
    return found


def f1(match: float, predicted: int, wanted: int) -> float:
    if not match:
        return 0.0
    p, r = match / predicted, match / wanted
    return 2 * p * r / (p + r)


def union_lcs(references: Sequence[Sequence[str]], candidates: Sequence[Sequence[str]]) -> float:
    """Summary-level LCS F1: per reference sentence the union over all candidates."""
    wanted, predicted = sum(map(len, references)), sum(map(len, candidates))
    if not wanted or not predicted:
        return 0.0
    left_ref: dict[str, int] = {}
    left_can: dict[str, int] = {}
    for store, side in ((left_ref, references), (left_can, candidates)):
        for sentence in side:
            for t in sentence:
                store[t] = store.get(t, 0) + 1
    hits = 0
    for sentence in references:
        covered: set[int] = set()
        for candidate in candidates:
            covered |= lcs_positions(sentence, candidate)
        for i in sorted(covered):
            t = sentence[i]
            if left_ref.get(t, 0) > 0 and left_can.get(t, 0) > 0:
                hits += 1
                left_ref[t] -= 1
                left_can[t] -= 1
    return f1(hits, predicted, wanted)


def edit_distance(a: Sequence[str], b: Sequence[str]) -> int:
    """Word edits from ``a`` to ``b``, by bit vectors over the longer list."""
    if not a:
        return len(b)
    masks, width = match_masks(a), len(a)
    full, top = (1 << width) - 1, 1 << (width - 1)
    plus, minus, score = full, 0, width
    for t in b:
        eq = masks.get(t, 0)
        diag = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(diag | plus)), plus & diag
        score += bool(up & top) - bool(down & top)
        up = ((up << 1) | 1) & full
        plus = ((down << 1) & full) | (full & ~(diag | up))
        minus = up & diag
    return score


def _pairs_from_the_end(left: list[int], right: list[int], a: Sequence[str], b: Sequence[str]):
    """Positions of equal words, the last occurrences first; what is left over."""
    places: dict[str, list[int]] = {}
    for j in right:
        places.setdefault(b[j], []).append(j)
    pairs, rest = [], []
    for i in reversed(left):
        spot = places.get(a[i])
        if spot:
            pairs.append((i, spot.pop()))
        else:
            rest.append(i)
    taken = {j for _, j in pairs}
    return pairs, rest[::-1], [j for j in right if j not in taken]


def meteor(
    prediction: Sequence[str],
    references: Sequence[Sequence[str]],
    alpha: float = 0.9,
    beta: float = 3.0,
    gamma: float = 0.5,
    synonyms: dict[str, str] | None = None,
) -> float:
    """Best METEOR over the references: exact, then stem, then synonym-class matches."""
    best = 0.0
    a = [t.lower() for t in prediction]
    stems: dict[str, str] = {}

    def stem_once(t: str) -> str:
        if t not in stems:
            stems[t] = stem(t)
        return stems[t]

    forms: list[Callable[[str], str]] = [str, stem_once]
    if synonyms:
        forms.append(lambda t: synonyms.get(t, t))
    for reference in references:
        b = [t.lower() for t in reference]
        left, right, pairs = list(range(len(a))), list(range(len(b))), []
        for form in forms:
            found, left, right = _pairs_from_the_end(left, right, [form(t) for t in a], [form(t) for t in b])
            pairs += found
        if not pairs:
            continue
        pairs.sort()
        chunks = 1 + sum(
            1 for (i, j), (k, m) in zip(pairs, pairs[1:]) if k != i + 1 or m != j + 1
        )
        p, r = len(pairs) / len(a), len(pairs) / len(b)
        mean = p * r / (alpha * p + (1 - alpha) * r)
        best = max(best, (1 - gamma * (chunks / len(pairs)) ** beta) * mean)
    return best


def _plain(arrays: pd.Series):
    """The lists of a batch, one row at a time."""

    def to_list(x):
        return [to_list(y) for y in x] if isinstance(x, (np.ndarray, list)) else x

    return (to_list(a) for a in arrays)


@F.pandas_udf(T.DoubleType())
def rouge_l_udf(reference: pd.Series, prediction: pd.Series) -> pd.Series:
    return pd.Series(
        [f1(lcs_length(r, p), len(p), len(r)) for r, p in zip(_plain(reference), _plain(prediction))], dtype="float64"
    )


@F.pandas_udf(T.DoubleType())
def rouge_lsum_udf(reference: pd.Series, prediction: pd.Series) -> pd.Series:
    return pd.Series([union_lcs(r, p) for r, p in zip(_plain(reference), _plain(prediction))], dtype="float64")


@F.pandas_udf(T.IntegerType())
def word_edits_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([edit_distance(x, y) for x, y in zip(_plain(a), _plain(b))], dtype="int32")


def meteor_udf(alpha: float = 0.9, beta: float = 3.0, gamma: float = 0.5, synonyms: dict[str, str] | None = None):
    @F.pandas_udf(T.DoubleType())
    def run(prediction: pd.Series, references: pd.Series) -> pd.Series:
        return pd.Series(
            [meteor(p, r, alpha, beta, gamma, synonyms) for p, r in zip(_plain(prediction), _plain(references))], dtype="float64"
        )

    return run


def _relist(lists: pa.Array, values: pa.Array) -> pa.Array:
    """``values`` cut up like the elements of ``lists``."""
    return pa.ListArray.from_arrays(pc.subtract(lists.offsets, lists.offsets[0]), values)


def _stem_lists(batch: pa.Array) -> pa.Array:
    flat = batch.flatten().dictionary_encode()
    stems = pa.array([stem(t) if len(t) > 3 else t for t in flat.dictionary.to_pylist()], pa.string())
    return _relist(batch, stems.take(flat.indices))


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_words(batch: pa.Array) -> pa.Array:
    """Porter stems of words longer than three letters; distinct words are stemmed once."""
    return _stem_lists(batch)


@F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
def stem_lines(batch: pa.Array) -> pa.Array:
    """The same for the word lists of several lines."""
    return _relist(batch, _stem_lists(batch.flatten()))


@F.pandas_udf(T.StructType().add("precision", T.DoubleType()).add("recall", T.DoubleType()))
def greedy_cosine_udf(predicted: pd.Series, reference: pd.Series) -> pd.DataFrame:
    """For each pair of vector lists the mean best cosine, seen from both sides."""
    out = np.zeros((len(predicted), 2))
    for row, (p, r) in enumerate(zip(predicted, reference)):
        if len(p) and len(r):
            a, b = np.stack(p).astype("float64"), np.stack(r).astype("float64")
            a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
            b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
            cos = a @ b.T
            out[row] = cos.max(axis=1).mean(), cos.max(axis=0).mean()
    return pd.DataFrame(out, columns=["precision", "recall"])


@F.pandas_udf(T.StructType().add("precision", T.DoubleType()).add("recall", T.DoubleType()))
def weighted_cosine_udf(predicted: pd.Series, reference: pd.Series) -> pd.DataFrame:
    """The same for lists of (vector, weight): means of the best cosines by weight."""
    out = np.zeros((len(predicted), 2))
    for row, sides in enumerate(zip(predicted, reference)):
        if not all(len(s) for s in sides):
            continue
        (a, v), (b, w) = ((np.stack([x["vector"] for x in s]).astype("float64"), np.array([x["weight"] for x in s])) for s in sides)
        a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)
        b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
        cos = a @ b.T
        out[row] = [best @ u / u.sum() if u.sum() else 0.0 for best, u in ((cos.max(axis=1), v), (cos.max(axis=0), w))]
    return pd.DataFrame(out, columns=["precision", "recall"])
