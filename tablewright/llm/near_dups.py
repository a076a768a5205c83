"""Near-duplicate documents by ProbMinHash.

A text is the weighted set of its shingles, five consecutive words `[^\\x20\\x09-\\x0D]+` weighed
by how often they occur (all words are one shingle where there are fewer than five). Two
texts are linked if their probability Jaccard similarity is ``SIMILARITY`` or more; classes are
what links connect.

Signature. Every shingle starts a Poisson process whose rate is its weight; each arrival
falls on a register drawn from its own hash and claims it if it comes first. A shingle
stops as soon as its next arrival is later than the last claimed register: most shingles
are looked at once. Two registers agree with the probability Jaccard as probability.

Banding. ``ROWS`` registers make a key, ``BANDS`` keys a signature; at similarity 0.8 a pair shares
no key with probability 5e-6.

Verification. Equal texts are one node before anything else. Texts that share a key form a
bucket. The smallest node of a bucket is compared with all others by the exact similarity
of the whole texts, and links are connected to classes. In buckets that still hold several
classes, the nodes of different classes are compared block by block inside the tasks: no
pairs are emitted but those that join two classes. So every pair that could join two
classes is compared in the end. Nodes, links and classes are frames throughout.

Defined cases: a null text is alone in its class; equal texts share one, also the empty
text; texts without words are never similar to others. The class id is the smallest doc_id
of the class, null if it has none. Repeated rows each get a row of result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.tables import BROADCAST_ROWS, joined_small, shuffle_width, stored
from tablewright.llm.textkit import PLAIN, Runs, buffer_of, grouped, mix, slices, window_hashes, window_starts

SHINGLE = 5
SIMILARITY = 0.8
ROWS = 6
BANDS = 40
SIGN_BYTES = 2 << 20
BLOCK_NODES = 64
BLOCK_BYTES = 256 << 10
TABLE_CELLS = 1 << 24
EDGES_EACH = 1_000_000
LEAST_PARTS = 8


def shingles(column: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of every distinct shingle of each text."""
    runs = Runs(*buffer_of(column), PLAIN)
    hashes = runs.hashes()
    starts = window_starts(runs, width)
    found = [window_hashes(hashes, width)[starts]] if len(starts) else []
    rows = [runs.row[starts]]
    short = np.flatnonzero((runs.counts > 0) & (runs.counts < width))
    for n in range(1, width):
        some = short[runs.counts[short] == n]
        if len(some):
            found.append(window_hashes(hashes, n)[runs.first[some]])
            rows.append(some)
    rows = np.concatenate(rows)
    values = np.concatenate([np.zeros(0, np.uint64), *found])
    order, new = grouped(mix(values + mix(rows.astype(np.uint64) + np.uint64(1))))
    first = np.flatnonzero(new)
    return rows[order][first], values[order][first], np.diff(np.append(first, len(order)))


def signatures(rows: np.ndarray, items: np.ndarray, weights: np.ndarray, texts: int, size: int) -> np.ndarray:
    """Registers of each text: the hash of the shingle that claimed it, 0 where none did."""
    times = np.full(texts * size, np.inf)
    owner = np.zeros(texts * size, np.uint64)
    clock = np.zeros(len(items))
    turn = 0
    while len(items):
        turn += 1
        draw = mix(items + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        clock = clock - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights
        slot = rows * size + (mix(draw ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(size)).astype(np.int64)
        np.minimum.at(times, slot, clock)
        won = times[slot] == clock
        owner[slot[won]] = items[won]
        live = np.unique(rows)
        last = np.zeros(texts)
        last[live] = times.reshape(texts, size)[live].max(axis=1)
        go = clock < last[rows]
        rows, items, weights, clock = rows[go], items[go], weights[go], clock[go]
    return owner.reshape(texts, size)


def band_keys(owner: np.ndarray, bands: int) -> np.ndarray:
    """Keys of the bands, each different from those of other bands."""
    texts, size = owner.shape
    parts = owner.reshape(texts, bands, size // bands)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (texts, bands)).copy()
    for i in range(parts.shape[2]):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, i])
    return keys


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two weighted sets, given as sorted items with weights."""
    items = np.union1d(a[0], b[0])
    x, y = np.zeros(len(items)), np.zeros(len(items))
    x[np.searchsorted(items, a[0])] = a[1]
    y[np.searchsorted(items, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # for ratios up to an item's own, x counts, for those above, y
    end = np.searchsorted(ratio, ratio, side="right")
    below = np.concatenate(([0.0], np.cumsum(x)))[end]
    above = y.sum() - np.concatenate(([0.0], np.cumsum(y)))[end]
    both = (x > 0) & (y > 0)
    return float((1.0 / (below[both] / x[both] + above[both] / y[both])).sum())


def signed(docs: DataFrame, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """doc_id, node (the text's hash) and the band keys of every text with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", SIGN_BYTES):
                row, items, counts = shingles(piece.column("text"))
                owner = signatures(row, items, counts.astype(np.float64), piece.num_rows, rows * bands)
                keys = band_keys(owner, bands)
                size = np.zeros(piece.num_rows, np.int64)
                size[np.unique(row)] = bands
                flat = pa.array(keys[size > 0].ravel().view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("node"), lists], ["doc_id", "node", "keys"])

    texts = docs.select("doc_id", F.xxhash64("text").alias("node"), "text").filter(F.col("text").isNotNull())
    return texts.mapInArrow(run, "doc_id bigint, node bigint, keys array<bigint>")


def verified(edges: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The edges (a, b) whose texts are similar enough."""

    def weighed(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        rows, items, counts = shingles(column)
        order = np.lexsort((items, rows))
        cuts = np.searchsorted(rows[order], np.arange(1, len(column)))
        return list(zip(np.split(items[order], cuts), np.split(counts[order], cuts), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text_a"):
                pairs = zip(weighed(piece.column("text_a")), weighed(piece.column("text_b")), strict=True)
                near = [len(x[0]) > 0 and probability_jaccard(x, y) >= similarity - 1e-9 for x, y in pairs]
                yield piece.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return edges.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


def across(named: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links between classes that meet in a bucket.

    named has key, node and class. Every pair of nodes of different classes in a bucket is
    compared, block against block: a row holds two blocks of at most ``BLOCK_NODES`` nodes, of
    about ``BLOCK_BYTES`` of text, and gives back at most one link for each two classes it joins.
    """
    mixed = named.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high").select("key")
    sizes = texts.select("node", F.greatest(F.octet_length("text"), F.lit(BLOCK_BYTES // BLOCK_NODES)).cast("bigint").alias("bytes"))
    order = Window.partitionBy("key").orderBy("class", "node")
    before = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    place = F.floor(F.coalesce(before, F.lit(0)) / BLOCK_BYTES)
    ranked = named.join(mixed, "key").join(sizes, "node").select("key", "node", "class", place.alias("block"))
    blocks = ranked.join(texts, "node").groupBy("key", "block").agg(
        F.min("class").alias("low"), F.max("class").alias("high"), F.collect_list(F.struct("node", "class", "text")).alias("docs")
    )
    # few bytes but much work: a given number of tasks is not merged
    blocks = blocks.repartition(4 * shuffle_width(named.sparkSession), "key")
    a, b = blocks.alias("a"), blocks.alias("b")
    apart = (F.col("a.block") <= F.col("b.block")) & (F.least("a.low", "b.low") < F.greatest("a.high", "b.high"))
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & apart)
    own = F.col("a.block") == F.col("b.block")
    pairs = pairs.select(F.col("a.docs").alias("left"), F.when(~own, F.col("b.docs")).otherwise(F.array()).alias("right"))

    # rows are large: they go to Python in batches by their bytes, which Arrow does not do
    @F.udf(returnType="array<struct<a:bigint,b:bigint>>", useArrow=False)
    def compare(left, right):
        return links_of(left, right, similarity)

    return pairs.select(F.explode(compare("left", "right")).alias("link")).select("link.*").distinct()


def possible(rows: np.ndarray, items: np.ndarray, counts: np.ndarray, n: int, half: int, similarity: float) -> np.ndarray:
    """Which pairs may be similar enough, by a bound that holds for every pair and is exact for
    texts of equal length without repeated shingles: of the shared items the larger of the
    two relative weights, over all items the same. ``half`` is 0 for pairs within one block."""
    first, second = (slice(0, half), slice(half, n)) if half else (slice(0, n), slice(0, n))
    _, column = np.unique(items, return_inverse=True)
    width = int(column.max()) + 1 if len(column) else 1
    levels = np.repeat(np.arange(len(rows)), counts)  # an item that occurs k times has k levels
    level = np.arange(len(levels)) - np.repeat(np.cumsum(counts) - counts, counts)
    _, place = np.unique(column[levels] + level * width, return_inverse=True)
    if n * max(width, len(levels) and int(place.max()) + 1) > TABLE_CELLS:
        out = np.ones((half or n, n - half), bool)  # very long texts: each pair is compared
    else:
        total = np.maximum(np.bincount(rows, counts, minlength=n), 1).astype(np.float32)
        share, there = np.zeros((n, width), np.float32), np.zeros((n, width), np.float32)
        share[rows, column], there[rows, column] = counts / total[rows], 1
        deep = np.zeros((n, int(place.max()) + 1 if len(place) else 1), np.float32)
        deep[rows[levels], place] = 1
        least = (deep[first] @ deep[second].T) / np.maximum(total[first][:, None], total[second][None, :])
        shared = share[first] @ there[second].T + there[first] @ share[second].T
        out = (shared > 0) & (shared - least >= (similarity - 1e-4) * (2 - least))
    return out if half else np.triu(out, 1)


def links_of(left: list[tuple], right: list[tuple], similarity: float) -> list[tuple[int, int]]:
    """Similar nodes of different classes among ``left`` (if ``right`` is empty) or between the
    two, as few as join the same classes."""
    both = [*left, *right]
    node, mark = [x[0] for x in both], [x[1] for x in both]
    rows, items, counts = shingles(pa.array([x[2] for x in both], pa.string()))
    n, half = len(both), len(left)
    loose = possible(rows, items, counts, n, half if right else 0, similarity)
    order = np.lexsort((items, rows))
    cuts = np.searchsorted(rows[order], np.arange(n + 1))
    sets = lambda i: (items[order][cuts[i] : cuts[i + 1]], counts[order][cuts[i] : cuts[i + 1]])
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while x in root:
            x = root[x]
        return x

    found = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(loose)), strict=True):
        j += half if right else 0
        x, y = top(mark[i]), top(mark[j])
        if x != y and probability_jaccard(sets(i), sets(j)) >= similarity - 1e-9:
            root[max(x, y)] = min(x, y)
            found.append((node[i], node[j]))
    return found


def connected(links: DataFrame) -> DataFrame:
    """(node, class) of every linked node; class is the smallest node it is connected with.

    Large-star and small-star steps in turn: each makes the neighbours of a node point to
    the smallest of them, until nothing changes.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def with_least(df: DataFrame, rows: int) -> DataFrame:
        """df with m, the smallest b of each a; two numbers for each a, broadcast if they are few."""
        least = df.groupBy("a").agg(F.min("b").alias("m"))
        return df.join(F.broadcast(least) if rows <= BROADCAST_ROWS else least, "a")

    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    seen = state(edges)
    while True:
        rows = 2 * seen[0]
        both = with_least(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), rows)
        large = both.filter("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).filter("a <> b")
        joined = with_least(large, rows)
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        edges = stored(small.filter("a <> b").distinct().coalesce(max(LEAST_PARTS, -(-rows // EDGES_EACH))), "links")
        now = state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("class", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("class")).union(roots)


def classes(docs: DataFrame, similarity: float = SIMILARITY, rows: int = ROWS, bands: int = BANDS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every text that is not null, and (node, class) of the linked nodes."""
    docs = docs.select("doc_id", "text")
    marks = stored(signed(docs, rows, bands), "signatures")
    # copies collapse before the shuffle: a node's keys are sent once from each task
    keyed = marks.select("node", F.explode("keys").alias("key")).distinct()
    keyed = stored(keyed, "bands")
    shared = keyed.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("other")).filter("centre < other")
    members = stored(keyed.join(shared.select("key", "centre"), "key"), "buckets")

    wanted = stored(members.select("node").distinct(), "nodes")
    texts = joined_small(docs.filter(F.col("text").isNotNull()).withColumn("node", F.xxhash64("text")), wanted, ["node"])
    texts = stored(texts.groupBy("node").agg(F.min("text").alias("text")), "texts")

    tested = stored(members.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), "edges")
    links = stored(verified(tested, texts, similarity), "similar")
    label = connected(links)
    named = members.select("key", "node").join(label, "node", "left").withColumn("class", F.coalesce("class", "node"))
    more = stored(across(named, texts, similarity), "similar")
    if not more.isEmpty():
        stars = label.select(F.col("node").alias("a"), F.col("class").alias("b"))
        label = connected(stars.union(more))
    return marks.select("doc_id", "node"), label


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, and whether it is the first of its class."""
    docs = docs.select("doc_id", "text")
    marks, label = classes(docs, similarity)
    named = marks.join(label, "node", "left").withColumn("class", F.coalesce("class", "node"))
    ids = named.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    whole = named.join(ids, "class").select("doc_id", "class_id")
    alone = docs.filter(F.col("text").isNull()).select("doc_id", F.col("doc_id").alias("class_id"))
    return whole.union(alone)


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, without near copies: of each class the rows of the
    smallest (doc_id, text) stay, of repeated rows one. Rows with a null text stay."""
    marks, label = classes(docs, similarity)
    named = marks.distinct().join(label, "node", "left").withColumn("class", F.coalesce("class", "node"))
    # a class's first document, ids before null ids
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")
    first = named.groupBy("class").agg(F.min(order).alias("kept"))
    later = named.join(first, "class").filter(order != F.col("kept")).select(F.col("doc_id").alias("later_id"), F.col("node").alias("later_node"))
    later = stored(later, "later")
    later = F.broadcast(later) if later.count() <= BROADCAST_ROWS else later
    again = stored(marks.groupBy("doc_id", "node").count().filter("count > 1"), "again")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("key_id"), F.xxhash64("text").alias("key_node"), F.col("text").isNull().alias("empty"))
    found = (F.col("key_id").eqNullSafe(F.col("later_id"))) & (F.col("key_node") == F.col("later_node")) & ~F.col("empty")
    kept = rows.join(later, found, "left_anti")
    if again.isEmpty():
        return kept.select("row.*")
    repeated = (F.col("key_id").eqNullSafe(F.col("doc_id"))) & (F.col("key_node") == F.col("node")) & ~F.col("empty")
    once = kept.join(again, repeated, "left_semi").dropDuplicates(["key_id", "key_node"])
    return kept.join(again, repeated, "left_anti").union(once).select("row.*")
