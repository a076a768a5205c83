"""Toxicity of texts, read through disguises.

1. A character language model: runs of ``ORDER`` letters, counted over all documents.
2. Disguised spellings (digits and signs for letters, letters set apart, letters repeated)
   span a lattice of the characters that may have been meant. The Viterbi path under a
   channel model and the language model restores the word. What stands between letters set
   apart is read as nothing or as a word boundary, so the path may hold several words.
   Plain words have one path and are taken as they are.
3. The restored text is scored by a noisy-or over its words and their beginnings, so that
   inflected and compound forms count: each telling one that occurs makes the text toxic
   with the share of toxic rows among the rows that have it, whatever the others do. The
   telling ones come from a bounded sample of the labelled rows: of those whose
   crc32(doc_id as text) mod 5 is not 0, the ``TRAIN_ROWS`` smallest by a hash of the id.
   At most ``FEATURES`` are looked at; those that only echo stronger ones are left out.

Null and empty texts are scored as texts without words. A document with several labels is
toxic if one says so; a null label counts as none. Without any label of either kind all
scores are 0. A null id is not held out. Repeated rows each get their own result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.textkit import LOWER, Runs, buffer_of, byte_class, grouped, mix, slices

TRAIN_ROWS = 20_000
FEATURES = 4_096
LEAST_TOXIC = 4
LEAST_SHARE = 0.95
COVER = 3
FOLDS = 5
PREFIXES = (4, 5, 6, 7)
SPELLINGS = 200_000
KEPT_SIZE = 64

LETTERS = byte_class([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
BASIC = byte_class([(0x41, 0x5A), (0x61, 0x7A)])
SPACE = byte_class([(0x09, 0x0D), (0x20, 0x20)])

# Which letters a sign may stand for
SIGNS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "*": "aeiou",
}
SIGN_BYTES = byte_class([(ord(c), ord(c)) for c in SIGNS])
APART = byte_class([(ord(c), ord(c)) for c in " .-_*"])

ORDER = 4
LEAST_CHANCE = 1e-6
BOUNDARY = 0.5
KINDS = 28  # no letter, a to z, any other letter
PAST = KINDS ** (ORDER - 1)
KIND = np.zeros(256, np.int64)
KIND[0x61:0x7B] = np.arange(1, 27)
KIND[0x41:0x5B] = np.arange(1, 27)
KIND[0x80:] = 27

_SIGN = "[" + re.escape("".join(SIGNS)) + "]"
_ONE = "[a-z" + re.escape("".join(SIGNS)) + "]"
#: letters or signs set apart, at least three
SPACED = re.compile(rf"(?<!\S){_ONE}(?:([ .\-_*]){_ONE})(?:\1{_ONE})+(?![^\s.,;:!?])")
#: what makes a word look disguised
ODD = re.compile(rf"[a-z]{_SIGN}{{1,3}}[a-z]|^{_SIGN}{{1,2}}[a-z]{{2}}|[a-z]{{2}}[0-9@$]{{1,2}}$|([a-z])\1\1")
EDGE = " .,;:?\"'()[]"


def letter_counts(docs: DataFrame) -> DataFrame:
    """How often each run of ORDER letter kinds occurs in all texts: at most KINDS^ORDER rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(KINDS**ORDER, np.int64)
        for batch in batches:
            for piece in slices(batch, "text"):
                data, offs = buffer_of(piece.column("text"))
                kinds = np.zeros(len(data) + (ORDER - 1) * len(offs), np.int64)
                at = np.arange(len(data)) + (ORDER - 1) * np.repeat(np.arange(1, len(offs)), np.diff(offs))
                kinds[at] = KIND[data]
                code = sum(kinds[i : len(kinds) - ORDER + 1 + i] * KINDS ** (ORDER - 1 - i) for i in range(ORDER))
                total += np.bincount(code, minlength=KINDS**ORDER)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["code", "n"])

    return docs.select("text").mapInArrow(run, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a letter kind after ORDER - 1 others."""
    counts = np.zeros(KINDS**ORDER)
    seen = letter_counts(docs).toArrow()  # bounded by the alphabet
    counts[seen.column("code").to_numpy()] = seen.column("n").to_numpy()
    counts = counts.reshape((KINDS,) * ORDER)
    chance = np.full(KINDS, 1 / KINDS)
    for known in range(ORDER):  # the more other kinds follow the known ones, the less they tell
        here = counts.sum(axis=tuple(range(ORDER - 1 - known)))
        total, other = here.sum(axis=-1, keepdims=True), (here > 0).sum(axis=-1, keepdims=True)
        chance = np.where(total > 0, (here + other * chance) / np.maximum(total + other, 1), chance)
    return np.log(np.maximum(chance, LEAST_CHANCE))


@cache
def readings(sign: str, times: int, apart: bool = False) -> list[tuple[str, tuple[int, ...], float]]:
    """What a run of one character may have been meant as: text, its letter kinds and the
    channel's log probability. Set apart, a sign may also stand for itself."""
    kinds = lambda text: tuple(ord(c) - 96 if "a" <= c <= "z" else 27 for c in text)
    if sign.isalpha():
        once = {1: 0.97, 2: 0.1}.get(times, 0.5)
        found = [(sign, once)] if times == 1 else [(sign, once), (sign * 2, 1 - once)]
    elif sign in SIGNS:
        meant = SIGNS[sign]
        found = [("", 0.002), *[(c, 0.6 / len(meant)) for c in meant]]
        if times > 1:
            found += [(c * 2, 0.3 / len(meant)) for c in meant]
    else:
        return between(sign)
    out = [(text, kinds(text), float(np.log(p))) for text, p in found]
    return [*out, (f" {sign} ", (0,), float(np.log(0.3)))] if apart and sign in SIGNS else out


@cache
def between(separator: str) -> list[tuple[str, tuple[int, ...], float]]:
    """The readings of a separator: nothing, a word boundary, or a letter if it is a sign."""
    if not separator:
        return [("", (), 0.0)]
    signs = [x for x in readings(separator, 1) if x[0]] if separator in SIGNS else []
    return [("", (), float(np.log(1 - BOUNDARY))), (" ", (0,), float(np.log(BOUNDARY))), *signs]


def restored(token: str, chance: list[float], apart: bool = False) -> str:
    """The likeliest plain spelling of a disguised token; ``apart``: every second character is a
    separator, and the spelling may be several words."""
    if apart:
        units = list(zip(["", *token[1::2]], token[::2], [1] * (len(token) + 1), strict=False))
    else:
        units = [("", run[1], min(len(run[0]), 3)) for run in re.finditer(r"(.)\1*", token, re.DOTALL)]
    # by the last kinds as one number and how often the last character came, which is not read
    # yet: score and what was read, as a chain from the end
    paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    last = ""
    for gap, sign, times in [*units, ("", "", 0)]:
        onward: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        gaps = between(gap)
        for (before, n), (score, chain) in paths.items():
            if gap and sign == last:  # one run goes on
                at, p = (before, min(n + 1, 3)), score + gaps[0][2]
                if at not in onward or p > onward[at][0]:
                    onward[at] = (p, chain)
            for text, kinds, cost in readings(last, n, apart) if last else between(""):
                q, x = score + cost, before
                for k in kinds:
                    q, x = q + chance[x * KINDS + k], (x * KINDS + k) % PAST
                read = (chain, text) if text else chain
                for space, more, price in gaps:
                    if sign == last and not space:
                        continue
                    p, y = q + price, x
                    for k in more:
                        p, y = p + chance[y * KINDS + k], (y * KINDS + k) % PAST
                    at = (y, times)
                    if at not in onward or p > onward[at][0]:
                        onward[at] = (p, (read, space) if space else read)
        paths, last = onward, sign
    # a word ends here, unless a sign that stands for itself has ended it
    closed = lambda x: 0.0 if apart and x % KINDS == 0 else chance[x * KINDS]
    chain = max(((p + closed(x), chain) for (x, _), (p, chain) in paths.items()), key=lambda end: end[0])[1]
    out = []
    while chain:
        chain, text = chain
        out.append(text)
    return "".join(reversed(out))


class Restorer:
    """Plain spelling of whole texts; keeps the spellings of short tokens, up to a bound."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model.ravel().tolist(), {}

    def word(self, token: str, apart: bool = False) -> str:
        found = self.known.get((token, apart))
        if found is None:
            found = restored(token, self.model, apart)
            if len(token) <= KEPT_SIZE:
                if len(self.known) >= SPELLINGS:
                    self.known.clear()
                self.known[token, apart] = found
        return found

    def text(self, text: str) -> str:
        text = SPACED.sub(lambda m: " " + self.word(m[0], apart=True) + " ", text.lower())
        out = []
        for token in text.split():
            core = token.strip(EDGE)
            out.append(self.word(core) if ODD.search(core) else token)
        return " ".join(out)

    def column(self, column: pa.Array) -> pa.Array:
        """The texts, those with signs of a disguise restored."""
        data, offs = buffer_of(column)
        n = len(data)
        if n < 3:
            return column
        basic, sign, apart = BASIC[data], SIGN_BYTES[data], APART[data]
        low = LOWER[data]
        odd = np.zeros(n, bool)
        odd[1:] |= sign[:-1] & basic[1:]
        odd[2:] |= basic[:-2] & basic[1:-1] & sign[2:]
        odd[2:] |= basic[2:] & (low[2:] == low[1:-1]) & (low[1:-1] == low[:-2])
        one = basic | sign
        if n >= 5:
            odd[4:] |= one[:-4] & apart[1:-3] & one[2:-2] & apart[3:-1] & one[4:]
        flagged = np.flatnonzero(np.diff(np.concatenate(([0], np.cumsum(odd)))[offs]))
        if not len(flagged):
            return column
        texts = column.to_pylist()
        for i in flagged.tolist():
            texts[i] = self.text(texts[i] or "")
        return pa.array(texts, column.type)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word of each text and of the word's first bytes."""
    data, offs = buffer_of(column)
    words = Runs(data, offs, LETTERS)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = np.concatenate((LOWER[data], np.zeros(8, np.uint8)))
    head = np.ndarray((len(data),), "<u8", low, 0, (1,))[words.starts]
    lengths = words.ends - words.starts
    rows, found = [words.row], [words.hashes(LOWER)]
    for size in PREFIXES:
        long = lengths > size
        rows.append(words.row[long])
        found.append(mix((head[long] & np.uint64((1 << 8 * size) - 1)) * np.uint64(8) + np.uint64(size)))
    return np.concatenate(rows), np.concatenate(found)


@dataclass
class Model:
    """weights: log probability that a text with the key is not toxic on its account."""

    spelling: np.ndarray
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0

    def scores(self, column: pa.Array, restorer: Restorer) -> np.ndarray:
        n = len(column)
        total = np.full(n, self.bias)
        if len(self.keys):
            rows, found = features(restorer.column(column))
            at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            known = self.keys[at] == found
            pair = np.unique(rows[known] * len(self.keys) + at[known])
            total += np.bincount(pair // len(self.keys), self.weights[pair % len(self.keys)], minlength=n)
        return -np.expm1(total)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    doc = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """The language model of all documents and the classifier of the sample."""
    model = Model(language_model(docs))
    marked = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))
    # at most train_rows rows of two numbers
    sample = F.broadcast(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    spelling = model.spelling

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(spelling)
        for batch in batches:
            for piece in slices(batch, "text"):
                rows, found = features(restorer.column(piece.column("text")))
                order, new = grouped(mix(found + mix(rows.astype(np.uint64))))
                first = np.sort(order[new])
                first = first[np.argsort(rows[first], kind="stable")]
                counts = np.bincount(rows[first], minlength=piece.num_rows)
                offs = np.concatenate(([0], np.cumsum(counts)))
                lists = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(found[first].view(np.int64)))
                yield pa.RecordBatch.from_arrays([piece.column("toxic"), piece.column("copy"), lists], ["toxic", "copy", "found"])

    texts = docs.select("doc_id", "text").join(sample, "doc_id").select("toxic", F.xxhash64("text").alias("copy"), "text")
    once = texts.mapInArrow(run, "toxic double, copy bigint, found array<bigint>").dropDuplicates(["copy"]).checkpoint()
    toxic, total = (once.agg(F.sum("toxic"), F.count("*")).first() or (0, 0))[:2]
    if not toxic or toxic == total:
        return model
    each = once.select("toxic", F.explode("found").alias("key")).groupBy("key").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    lift = F.col("bad") / toxic - (F.col("n") - F.col("bad")) / (total - toxic)
    telling = each.filter((F.col("bad") >= LEAST_TOXIC) & (F.col("bad") > LEAST_SHARE * F.col("n"))).withColumn("lift", lift)
    keys = np.sort(np.array([r["key"] for r in telling.orderBy(F.desc("lift"), "key").limit(FEATURES).select("key").collect()], np.int64).view(np.uint64))
    if not len(keys):
        return model
    kept = F.array(*[F.lit(int(k)) for k in keys.view(np.int64)])
    rows = once.select("toxic", F.array_intersect("found", kept).alias("found")).collect()  # at most train_rows
    y = np.array([r["toxic"] for r in rows])
    lists = [np.searchsorted(keys, np.array(r["found"], np.int64).view(np.uint64)) for r in rows]
    chosen = explaining(lists, y, len(keys))
    flat = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64)
    mark = np.repeat(y, [len(x) for x in lists])
    bad, n = np.bincount(flat, mark, len(keys))[chosen], np.bincount(flat, minlength=len(keys))[chosen]
    model.keys = keys[chosen]
    model.weights = np.log1p(-bad / (n + 1))
    rest = np.array([not np.isin(x, chosen).any() for x in lists])
    model.bias = float(np.log1p(-(y[rest].sum() + 0.01) / (rest.sum() + 1)))
    return model


def explaining(lists: list[np.ndarray], y: np.ndarray, size: int, times: int = COVER) -> np.ndarray:
    """The features that explain the toxic rows, most telling first: one that adds to fewer
    than LEAST_TOXIC rows not yet explained ``times`` times only echoes others."""
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    cols = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64)
    bad = np.bincount(cols, y[rows], minlength=size)
    lift = bad / y.sum() - (np.bincount(cols, minlength=size) - bad) / (len(y) - y.sum())
    order = np.argsort(cols, kind="stable")
    where = np.split(rows[order], np.searchsorted(cols[order], np.arange(1, size)))
    done, out = np.zeros(len(y), np.int64), []
    for k in np.argsort(-lift, kind="stable").tolist():
        mine = where[k][y[where[k]] > 0]
        if (done[mine] < times).sum() >= LEAST_TOXIC:
            done[mine] += 1
            out.append(k)
    return np.sort(np.array(out, np.int64))


def scored(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    model = fit(docs, labels, train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.spelling)
        for batch in batches:
            for piece in slices(batch, "text"):
                score = model.scores(piece.column("text"), restorer)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(score), pa.array(score >= 0.5).cast(pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below one half."""
    model = fit(docs, labels, train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.spelling)
        for batch in batches:
            for piece in slices(batch, "text"):
                yield piece.filter(pa.array(model.scores(piece.column("text"), restorer) < 0.5))

    return docs.mapInArrow(run, docs.schema)
