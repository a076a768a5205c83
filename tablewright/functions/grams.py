"""N-grams of token lists, counted by numbers in Arrow batches.

Inside a batch every distinct n-gram has a number of its own, so counts are exact. Where n-grams of
several batches meet, 128 bits stand for the tokens.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_KEYS = ("0123456789123456", "tablewright-gram")
_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_MIX = tuple(np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def sizes_of(lists: pa.Array) -> np.ndarray:
    """Elements of each list or characters of each text, none for null."""
    if pa.types.is_string(lists.type):
        return pc.fill_null(pc.utf8_length(lists), 0).to_numpy().astype(np.int64)
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each element the list it is in, and how many elements of this list start with it."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return rows, np.repeat(np.cumsum(sizes), sizes) - np.arange(len(rows))


def numbered(lists: pa.Array, orders: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each order the list and the number of every n-gram of the token lists; equal n-grams of one
    order have equal numbers. Texts in place of lists stand for their characters."""
    rows, left = _places(sizes_of(lists))
    if pa.types.is_string(lists.type):
        text = "".join(x or "" for x in lists.to_pylist())
        ids, width = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64), 0x110000
    else:
        tokens = lists.flatten().dictionary_encode()
        ids, width = tokens.indices.to_numpy().astype(np.int64), max(len(tokens.dictionary), 1)
    codes = ids
    for n in range(1, max(orders, default=0) + 1):
        if n > 1:
            keep = left >= n
            at = np.flatnonzero(keep)
            # codes so far belong to the elements that start a run of n - 1
            codes = codes[keep[starts]] * width + ids[at + (n - 1)]
            codes = pd.factorize(codes)[0].astype(np.int64)
        starts = np.flatnonzero(left >= n)
        if n in orders:
            yield n, rows[starts], codes


def hashed(lists: pa.Array, orders: Sequence[int]) -> Iterator[tuple[int, np.ndarray, tuple[np.ndarray, np.ndarray]]]:
    """The same with two 64-bit hashes of each n-gram instead of its number."""
    tokens = lists.flatten().dictionary_encode()
    return hashed_ids(tokens.dictionary, tokens.indices.to_numpy(), sizes_of(lists), orders)


def word_hashes(words: pa.Array) -> list[np.ndarray]:
    texts = words.to_numpy(zero_copy_only=False)
    return [pd.util.hash_array(texts, hash_key=k, categorize=False) if len(texts) else np.zeros(0, np.uint64) for k in _KEYS]


def longer(sums: Sequence[np.ndarray], own: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The hashes of n-grams that go on by one word each."""
    found = []
    for odd, a, b in zip(_ODD, sums, own, strict=True):
        x = a * odd + b
        x = (x ^ (x >> np.uint64(30))) * _MIX[0]
        x = (x ^ (x >> np.uint64(27))) * _MIX[1]
        found.append(x ^ (x >> np.uint64(31)))
    return found


def hashed_ids(
    words: pa.Array, ids: np.ndarray, sizes: np.ndarray, orders: Sequence[int]
) -> Iterator[tuple[int, np.ndarray, tuple[np.ndarray, np.ndarray]]]:
    """``hashed`` of lists of so many tokens, which are numbers of ``words``."""
    rows, left = _places(sizes)
    each = [x[ids] for x in word_hashes(words)]
    sums = each
    for n in range(1, max(orders, default=0) + 1):
        if n > 1:
            sums = longer([x[:-1] for x in sums], [x[n - 1 :] for x in each])
        if n in orders:
            starts = np.flatnonzero(left >= n)
            yield n, rows[starts], tuple(s[starts] for s in sums)


def tallied(keys: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of some columns of numbers, and how often each occurs."""
    names = [f"k{i}" for i in range(len(keys))]
    found = pa.table({n: pa.array(k) for n, k in zip(names, keys, strict=True)}).group_by(names).aggregate([([], "count_all")])
    return [found[n].to_numpy() for n in names], found["count_all"].to_numpy()


def matches(lists: pa.Array, example: np.ndarray, side: np.ndarray, examples: int, orders: Sequence[int]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each order (match, predicted, wanted) of each example.

    ``lists`` are token lists of the examples ``example``; side 0 is predicted, each other side a
    reference. Of an n-gram the lesser count of prediction and references matches, and the highest
    count in a reference is wanted.
    """
    out = {}
    for n, rows, codes in numbered(lists, orders):
        (whose, which, code), count = tallied([example[rows], side[rows], codes])
        where = pd.factorize(whose * (int(code.max(initial=0)) + 1) + code)[0]
        total = int(where.max(initial=-1)) + 1
        owner = np.zeros(total, np.int64)
        owner[where] = whose
        predicted, wanted = np.zeros(total, np.int64), np.zeros(total, np.int64)
        own = which == 0
        predicted[where[own]] = count[own]
        np.maximum.at(wanted, where[~own], count[~own])
        out[n] = tuple(np.bincount(owner, x, examples).astype(np.int64) for x in (np.minimum(predicted, wanted), predicted, wanted))
    return out
