"""Benchmark decontamination by Wu-Manber multi-pattern search.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z became a-z. A pattern is a window of
``WINDOW`` consecutive words of a benchmark item, its words each followed by one space; an
item with fewer words, but not none, is one pattern. Documents are brought to the same
form, so that a pattern occurs exactly where its window does.

For the patterns of one length class, m is the shortest length. A table tells for every
hashed block of text bytes how far the next possible block is away; most positions are
never looked at. A block at which some pattern's m-th byte could end leads to the patterns
with this very block, and these are compared byte by byte. Searching runs in many lanes of
a text buffer at once, each lane with its own position.

The patterns of up to ``ITEM_BYTES`` of benchmark text are held by each task. A larger
benchmark is searched in several such parts, one after another in the same pass over the
documents, so that no size is left out.

Null and empty texts have no words. Repeated rows each get their own result. Items with the
same text count as one item each; items without an id mark words but are not listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.textkit import ALNUM, LOWER, Runs, buffer_of, covered, mix, slices

WINDOW = 10
ITEM_BYTES = 16 << 20
SHIFT_BITS = 20
LANE = 4096
#: patterns are searched by length class, so that one short item does not shorten all steps
CLASSES = (1, 2, 4, 8, 16, 32)

RESULT = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray, Runs]:
    """Texts as one buffer (a line end before each text, a space after each word), the
    place of each word in it, and the words."""
    data, offs = buffer_of(column)
    runs = Runs(data, offs, ALNUM)
    lengths = runs.ends - runs.starts
    begin = np.cumsum(lengths) - lengths + np.arange(len(runs)) + runs.row + 1
    out = np.full(int(lengths.sum()) + len(runs) + len(offs) - 1 + 8, 0x20, np.uint8)
    inner = LOWER[data[runs.inside]]
    out[np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(inner))] = inner
    texts = np.arange(len(offs) - 1)
    heads = np.concatenate(([0], np.cumsum(lengths + 1)))[runs.first[:-1]] + texts
    out[heads] = 0x0A
    return out, begin, runs


def patterns_of(items: list[tuple[object, str]], window: int = WINDOW) -> dict[bytes, tuple[int, set[str]]]:
    """Pattern bytes -> number of words, ids of the items that have it."""
    found: dict[bytes, tuple[int, set[str]]] = {}
    for item, text in items:
        out, begin, runs = plain(pa.array([text], pa.string()))
        n = len(runs)
        body = out.tobytes()
        ends = begin + (runs.ends - runs.starts) + 1
        width = min(window, n)
        for i in range(n - width + 1 if n else 0):
            key = body[begin[i] : ends[i + width - 1]]
            ids = found.setdefault(key, (width, set()))[1]
            if item is not None:
                ids.add(str(item))
    return found


class WuManber:
    """Search for patterns that are at least ``m`` bytes long."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.m = min(map(len, patterns))
        self.block = min(8, self.m)
        self.keep = np.uint64((1 << (8 * self.block)) - 1)
        reach = self.m - self.block + 1
        self.shift = np.full(1 << SHIFT_BITS, reach, np.int32)
        heads = np.frombuffer(b"".join(p[: self.m] for p in patterns), np.uint8).reshape(len(patterns), self.m)
        for j in range(reach):
            blocks = self.value(np.pad(np.ascontiguousarray(heads[:, j : j + self.block]), ((0, 0), (0, 8 - self.block))).view("<u8")[:, 0])
            np.minimum.at(self.shift, self.slot(blocks), reach - 1 - j)
        order = np.argsort(blocks, kind="stable")
        self.suffixes, first = np.unique(blocks[order], return_index=True)
        self.bucket = np.split(order, first[1:])

    def value(self, blocks: np.ndarray) -> np.ndarray:
        return blocks & self.keep

    def slot(self, blocks: np.ndarray) -> np.ndarray:
        return (mix(blocks) >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)

    def find(self, text: np.ndarray) -> Iterator[tuple[int, int]]:
        """(place, pattern number) of every occurrence that starts a word."""
        size = len(text) - 8
        if size < self.m:
            return
        blocks = np.ndarray((size,), "<u8", text, 0, (1,))
        at = np.arange(0, size, LANE)
        stop = np.minimum(at + LANE, size)
        zeros = []
        while len(at):
            step = self.shift[self.slot(self.value(blocks[at]))]
            here = step == 0
            if here.any():
                zeros.append(at[here])
            at = at + np.maximum(step, 1)
            go = at < stop
            at, stop = at[go], stop[go]
        if not zeros:
            return
        places = np.concatenate(zeros)
        seen = self.value(blocks[places])
        k = np.searchsorted(self.suffixes, seen)
        real = self.suffixes[np.minimum(k, len(self.suffixes) - 1)] == seen
        begin = places - (self.m - self.block)
        real &= begin >= 1
        real[real] = np.isin(text[begin[real] - 1], (0x20, 0x0A))
        body = memoryview(text)
        for place, bucket in zip(begin[real].tolist(), k[real].tolist(), strict=True):
            for p in self.bucket[bucket].tolist():
                wanted = self.patterns[p]
                if body[place : place + len(wanted)] == wanted:
                    yield place, p


class Matcher:
    def __init__(self, items: list[tuple[object, str]]):
        found = patterns_of(items)
        self.keys = list(found)
        self.width = np.array([found[k][0] for k in self.keys], np.int64)
        self.items = [found[k][1] for k in self.keys]
        sizes = np.array([len(k) for k in self.keys])
        self.searches = []
        for low, high in zip(CLASSES, [*CLASSES[1:], 1 << 62], strict=True):
            chosen = np.flatnonzero((sizes >= low) & (sizes < high))
            if len(chosen):
                self.searches.append((chosen, WuManber([self.keys[i] for i in chosen])))

    def scan(self, column: pa.Array) -> tuple[Runs, np.ndarray, dict[int, set[str]]]:
        """Words of the texts, which of them are hit, and the items found in each text."""
        text, begin, runs = plain(column)
        starts, widths, items = [], [], {}
        for chosen, search in self.searches:
            for place, p in search.find(text):
                word = int(np.searchsorted(begin, place))
                starts.append(word)
                widths.append(self.width[chosen[p]])
                items.setdefault(int(runs.row[word]), set()).update(self.items[chosen[p]])
        hit = covered(np.array(starts, np.int64), np.array(widths, np.int64), len(runs))
        return runs, hit, items


def parts_of(benchmark: DataFrame, part_bytes: int) -> list[list[tuple[object, str]]]:
    """The items in parts of about ``part_bytes``; the bytes are measured before any part
    is fetched."""
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // part_bytes) or 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [[(r[0], r[1]) for r in items.filter(part == k).collect()] for k in range(n)]


def _search(docs: DataFrame, benchmark: DataFrame, schema: str, finish, part_bytes: int) -> DataFrame:
    """Scan every row's text for all parts; ``finish`` makes the output batch."""
    sc = docs.sparkSession.sparkContext
    shared = [sc.broadcast(part) for part in parts_of(benchmark, part_bytes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = [Matcher(part.value) for part in shared]
        for batch in batches:
            for piece in slices(batch, "text"):
                found = [m.scan(piece.column("text")) for m in matchers]
                runs, hit = found[0][0], found[0][1]
                items: dict[int, set[str]] = {}
                for _, more, each in found:
                    hit = hit | more
                    for row, ids in each.items():
                        items.setdefault(row, set()).update(ids)
                yield finish(piece, runs, hit, items)

    return docs.mapInArrow(run, schema)


def _report(piece: pa.RecordBatch, runs: Runs, hit: np.ndarray, items: dict[int, set[str]]) -> pa.RecordBatch:
    total = np.concatenate(([0], np.cumsum(hit)))[runs.first]
    n_hit = np.diff(total)
    names = [sorted(items.get(i, ())) for i in range(piece.num_rows)]
    return pa.RecordBatch.from_arrays(
        [
            piece.column("doc_id"),
            pa.array(runs.counts, pa.int64()),
            pa.array(n_hit, pa.int64()),
            pa.array([len(x) for x in names], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]),
            pa.array(n_hit > 0),
        ],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, part_bytes: int = ITEM_BYTES) -> DataFrame:
    """One row per document: its words, the words hit, the items whose windows occur."""
    return _search(docs.select("doc_id", "text"), benchmark, RESULT, _report, part_bytes)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, part_bytes: int = ITEM_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no benchmark window occurs."""

    def finish(piece, runs, hit, items):
        return piece.filter(pa.array(np.diff(np.concatenate(([0], np.cumsum(hit)))[runs.first]) == 0))

    return _search(docs, benchmark, docs.schema, finish, part_bytes)
