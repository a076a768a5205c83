"""Exact similarity join of documents on their sets of word shingles.

A document's set holds its distinct runs of ``SHINGLE`` words. Two documents are linked if their
sets' Jaccard similarity is ``PERCENT`` hundredths or more; components are what links connect.

Universe partition. Linked sets of a and b shingles differ in at most
(100 - PERCENT)(a + b) / (100 + PERCENT) shingles. Sizes are cut into bands, each half as large
again as the one before; a band's bound for its largest sets is H. A set takes part in its own
band and in the next one if a partner can be there. Hashing cuts the universe of shingles
into segments, and each set into a subset for each segment. By the pigeonhole principle two
linked sets are close in some segment: with `U > H` units of segments, where a segment that
only finds equal subsets is one unit and a segment that also finds subsets with one shingle
more or less is two, because it holds the subset and its one-deletion neighbourhood.

Allocation. How many segments of a band get a deletion neighbourhood is settled by cost, one
for each key and ``PAIR_COST`` for each pair that meets under a key. Both are measured over all
documents for every choice in ``CHOICES``: keys by counting, pairs by the second moment of a
sketch of the keys, less what equal sets contribute. Some units more than H + 1 are cut, so
that a set can leave out the keys of its empty subsets, which would meet those of every
other set: they are only used by a set whose other segments are too few for the bound, and
two such sets both use them.

Frequent keys. What a batch of texts has several times under one key is dealt out by key once and
held back otherwise, so that a key that a third of all sets have is few rows of each task.

Verification. Equal sets are one node before anything else. Each set has a parity bit vector,
made when sets are measured; the bits in which two differ are no more than the shingles in which
the sets differ, so bits leave out no link. The nodes under a key are compared with the first
of them, and links are connected. Where a key still holds several components, its nodes are
dealt out in blocks by a hash, and the pairs of blocks, as numbers, to tasks: one frequent key is
as many tasks as it has pairs of blocks, while one whose nodes fit a block is compared where they
are gathered. The pairs that bits let pass are verified by whole sets, first the best one for each
two components, then, if these still are apart, the others. So each two sets that could join two
components are compared, and texts are moved for the pairs that bits leave open, not for all nodes
that meet: the more documents there are, the more of them meet some other by chance.

Defined cases: null and empty texts, and those without words, have the empty set and are
linked with nothing; their component is their own id. A doc_id names one text and is less
than 2^62; rows of one doc_id are one document. Documents with null ids are linked like any
other, and a component that has no id at all gets null. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.near_dups import connected
from tablewright.llm.tables import joined_small, shuffle_width, stored
from tablewright.llm.textkit import LOWER, PLAIN, Runs, buffer_of, grouped, mix, slices, window_hashes, window_starts

SHINGLE = 4
PERCENT = 85
SPARE = 8  # one unit more for each so many
CHOICES = (0.0, 0.5, 1.0)  # shares of a band's units in segments with deletion neighbourhoods
PAIR_COST = 0.02
SKETCH = 64
NAMELESS = 1 << 62  # nodes of documents without an id lie from here on
LOCAL_MANY = 4  # nodes of one batch under one key
BLOCK_NODES = 512
BLOCK_BYTES = 256 << 10
BITS_EACH = 2
U64 = np.uint64
HALF = U64(32)


@dataclass(frozen=True)
class Bands:
    """Sizes ``low[k]`` to ``high[k]`` are band k. In band 0 linked sets are equal."""

    percent: int
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, percent: int = PERCENT, largest: int = 1 << 40) -> Bands:
        apart, both = 100 - percent, 100 + percent
        low, high = [1], [max(1, -(-both // (2 * apart)) - 1)]
        while high[-1] < largest:
            low.append(high[-1] + 1)
            high.append(max(-(-100 * low[-1] // percent), high[-1] * 3 // 2))
        return cls(percent, np.array(low), np.array(high))

    def differ(self, both: np.ndarray | int) -> np.ndarray | int:
        """The most shingles in which linked sets of so many shingles together differ."""
        return (100 - self.percent) * both // (100 + self.percent)

    def of_size(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.high, n)

    def units(self, band: np.ndarray) -> np.ndarray:
        least = self.differ(2 * self.high[band]) + 1
        return least + least // SPARE

    def needed(self, n: np.ndarray, band: np.ndarray) -> np.ndarray:
        """Units that a set of n shingles must have in use, whatever its partner in the band."""
        partner = np.minimum(self.high[band], 100 * n // self.percent)
        return self.differ(n + partner) + 1


@dataclass
class Sets:
    """Distinct shingles of a batch of texts, in the order of the texts."""

    row: np.ndarray
    item: np.ndarray
    size: np.ndarray

    def each(self) -> list[np.ndarray]:
        """The shingles of every text, in ascending order."""
        return np.split(self.item, np.cumsum(self.size)[:-1])


def sets_of(column: pa.Array, width: int = SHINGLE) -> Sets:
    runs = Runs(*buffer_of(column), PLAIN)
    words = runs.hashes(LOWER)
    starts = window_starts(runs, width)
    items, rows = [window_hashes(words, width)[starts]] if len(starts) else [], [runs.row[starts]]
    short = np.flatnonzero((runs.counts > 0) & (runs.counts < width))
    for n in range(1, width):
        some = short[runs.counts[short] == n]
        if len(some):
            items.append(window_hashes(words, n)[runs.first[some]] + U64(n))
            rows.append(some)
    row, item = np.concatenate(rows), np.concatenate([np.zeros(0, U64), *items])
    code = (row.astype(U64) << U64(48)) | (item >> U64(16))
    order = np.argsort(code)
    row, item, code = row[order], item[order], code[order]
    if ((code[1:] == code[:-1]) & (item[1:] != item[:-1])).any():
        order = np.lexsort((item, row))
        row, item = row[order], item[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    row, item = row[new], item[new]
    return Sets(row, item, np.bincount(row, minlength=len(column)))


def text_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for piece in slices(batch, "text"):
        for start in range(0, piece.num_rows, 1 << 15):
            yield piece.slice(start, 1 << 15)


def digests(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set, of which equal sets have the same."""
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.zeros(len(sets.size), U64)
        np.add.at(total, sets.row, mix(sets.item ^ U64(salt)))
        out.append(mix(total ^ sets.size.astype(U64)).view(np.int64))
    return out[0], out[1]


def keys_of(sets: Sets, band: np.ndarray, bands: Bands, with_deletions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, key and role (0: a subset, 1: a subset less one) of the sets' keys in the bands given for
    them, -1 for none; ``with_deletions`` is the share of a band's units in such segments."""
    live = np.flatnonzero((band > 0) & (sets.size > 0))
    if not len(live):
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int8)
    k, n = band[live], sets.size[live]
    units = bands.units(k)
    wide = (units * with_deletions[k]).astype(np.int64) // 2  # segments of two units
    count = units - wide
    base = np.cumsum(count) - count
    index = np.full(len(sets.size), -1)
    index[live] = np.arange(len(live))
    mine = index[sets.row]
    own = mine >= 0
    mine = mine[own]
    token = mix(sets.item[own] + mix(k.astype(U64) + U64(1))[mine])
    unit = ((token >> HALF) * units[mine].astype(U64) >> HALF).astype(np.int64)
    token = mix(token ^ U64(0x452821E638D01377))
    segment = np.where(unit < 2 * wide[mine], unit // 2, unit - wide[mine])
    cell = base[mine] + segment
    total = np.zeros(int(count.sum()), U64)
    np.add.at(total, cell, token)
    held = np.bincount(cell, minlength=len(total))
    owner = np.repeat(np.arange(len(live)), count)
    number = np.arange(len(total)) - base[owner]
    doubled = number < wide[owner]
    # a segment counts for what it finds without any empty subset
    worth = np.where(doubled, np.minimum(held, 2), np.minimum(held, 1))
    short = np.add.reduceat(worth, base) < bands.needed(n, k)
    place = mix(number.astype(U64) * U64(0x9E3779B97F4A7C15) + mix(k.astype(U64) + U64(77))[owner])
    use = (held > 0) | short[owner]
    deleted = doubled[cell] & ((held[cell] > 1) | short[mine])
    key = np.concatenate([mix(total[use] + place[use]), mix((total[cell] - token + place[cell])[deleted])])
    row = np.concatenate([live[owner[use]], live[mine[deleted]]])
    role = np.zeros(len(key), np.int8)
    role[int(use.sum()) :] = 1
    return row, key, role


def both_bands(sets: Sets, bands: Bands) -> list[np.ndarray]:
    """Each set's own band, and the next one where a partner can be there, else -1."""
    own = np.where(sets.size > 0, bands.of_size(sets.size), -1)
    above = np.where((sets.size > 0) & (100 * sets.size >= bands.percent * bands.low[own + 1]), own + 1, -1)
    return [own, above]


MARKS = "doc_id bigint, n bigint, hi bigint, lo bigint, bits binary, band int, choice int, entries bigint, sketch array<bigint>"


def measured(docs: DataFrame, bands: Bands) -> DataFrame:
    """A row per document with the size, digest, bits and band of its set; and for each partition
    rows with the keys of a band under a choice and their sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], list] = {}
        for batch in batches:
            for piece in text_slices(batch):
                sets = sets_of(piece.column("text"))
                hi, lo = digests(sets)
                both = both_bands(sets, bands)
                for choice, part in enumerate(CHOICES):
                    for band in both:
                        row, key, _ = keys_of(sets, band, bands, np.full(len(bands.low), part))
                        value = np.where(key >> U64(63), 1, -1)
                        cell = band[row] * SKETCH + (key & U64(SKETCH - 1)).astype(np.int64)
                        sums = np.bincount(cell, value, minlength=1).astype(np.int64)
                        n = np.bincount(band[row], minlength=1)
                        for k in np.flatnonzero(n).tolist():
                            old = seen.setdefault((k, choice), [0, np.zeros(SKETCH, np.int64)])
                            old[0] += int(n[k])
                            part_sums = sums[k * SKETCH : (k + 1) * SKETCH]
                            old[1][: len(part_sums)] += part_sums
                size = len(sets.size)
                none = [pa.nulls(size, t) for t in (pa.int32(), pa.int64(), pa.list_(pa.int64()))]
                own = pa.array(np.maximum(both[0], 0), pa.int32())
                yield batch_of([piece.column("doc_id"), pa.array(sets.size, pa.int64()), pa.array(hi), pa.array(lo), bits_of(sets), own, *none])
        for (k, choice), (n, sums) in seen.items():
            none = [*[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.binary())]
            yield batch_of([*none, pa.array([k], pa.int32()), pa.array([choice], pa.int32()), pa.array([n]), pa.array([sums], pa.list_(pa.int64()))])

    def batch_of(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "hi", "lo", "bits", "band", "choice", "entries", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, MARKS)


def allocation(found: DataFrame, sizes: DataFrame, bands: Bands) -> np.ndarray:
    """The cheapest choice for each band. ``sizes`` has band, documents and equal (the sum of the
    squares of the numbers of documents with the same set)."""
    cells = found.filter("choice IS NOT NULL").select("band", "choice", "entries", F.posexplode("sketch").alias("cell", "value"))
    sums = cells.groupBy("band", "choice", "cell").agg(F.sum("value").alias("value"), F.sum("entries").alias("entries"))
    moment = F.sum(F.col("value").cast("double") * F.col("value"))
    rows = sums.groupBy("band", "choice").agg(moment.alias("moment"), F.max("entries").alias("entries")).collect()  # some 100
    held = {r["band"]: (r["documents"], r["equal"]) for r in sizes.collect()}  # a row for each band
    best: dict[int, tuple[float, float]] = {}
    for r in rows:
        # sets of the next lower band take part too: both bands' copies count
        near = [held.get(r["band"] - i, (0, 0)) for i in (0, 1)]
        documents, equal = max(1, sum(x[0] for x in near)), sum(x[1] for x in near)
        pairs = max(0.0, r["moment"] - r["entries"] * equal / documents) / 2
        cost = r["entries"] + PAIR_COST * pairs
        if r["band"] not in best or (cost, CHOICES[r["choice"]]) < best[r["band"]]:
            best[r["band"]] = (cost, CHOICES[r["choice"]])
    return np.array([best.get(k, (0, 0.0))[1] for k in range(len(bands.low))])


def nameless(lo: Column) -> Column:
    """The node of a set that documents without an id have."""
    return F.lit(NAMELESS) + F.shiftrightunsigned(lo, 2)


def keyed(docs: DataFrame, bands: Bands, chosen: np.ndarray) -> DataFrame:
    """key, node, role, many and held of the sets' keys.

    A key that several nodes of a batch have becomes one row with ``many``, the first by role and node;
    the other rows are ``held`` back: they need not be dealt out by key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch):
                sets = sets_of(piece.column("text"))
                node = nodes_of(piece.column("doc_id"), sets)
                for band in both_bands(sets, bands):
                    row, key, role = keys_of(sets, band, bands, chosen)
                    order, new = grouped(key)
                    size = np.diff(np.append(np.flatnonzero(new), len(key)))
                    often = order[np.repeat(size >= LOCAL_MANY, size)]
                    many, held = np.zeros(len(key), bool), np.zeros(len(key), bool)
                    if len(often):
                        often = often[np.lexsort((node[row[often]], role[often], key[often]))]
                        many[often] = True
                        held[often[1:]] = key[often[1:]] == key[often[:-1]]
                    columns = [pa.array(key.view(np.int64)), pa.array(node[row]), pa.array(role), pa.array(many), pa.array(held)]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "node", "role", "many", "held"])

    return docs.select("doc_id", "text").mapInArrow(run, "key bigint, node bigint, role tinyint, many boolean, held boolean")


def members_of(keys: DataFrame) -> DataFrame:
    """key, centre and node for the keys that several nodes have, one of them as a whole subset; the
    centre is the first such node."""
    ordered = Window.partitionBy("key").orderBy("role", "node")
    seen = keys.filter("NOT held").select(
        "key", "node", "many",
        F.first("node").over(ordered).alias("centre"), F.first("role").over(ordered).alias("least"),
        F.lag("node").over(ordered).alias("before"), F.lead("node").over(ordered).alias("after"),
    )
    shared = stored(seen.filter("least = 0 AND (many OR before IS NOT NULL OR after IS NOT NULL)").select("key", "centre", "node", "many"), "members")
    heads = shared.filter("many").select("key", "centre").distinct()
    rest = keys.filter("held").select("key", "node").join(heads, "key").select("key", "centre", "node")
    return shared.select("key", "centre", "node").union(rest)


def with_nodes(docs: DataFrame) -> DataFrame:
    """node and text of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch):
                node = nodes_of(piece.column("doc_id"), sets_of(piece.column("text")))
                yield pa.RecordBatch.from_arrays([pa.array(node), piece.column("text")], ["node", "text"])

    ids = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("node"), "text")
    return ids.union(docs.filter("doc_id IS NULL").select("doc_id", "text").mapInArrow(run, "node bigint, text string"))


def texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and text of the stored nodes, the first text where rows of a node have several."""
    return joined_small(with_nodes(docs), nodes, ["node"]).groupBy("node").agg(F.min("text").alias("text"))


def nodes_of(doc_id: pa.Array, sets: Sets) -> np.ndarray:
    lost = (digests(sets)[1].view(U64) >> U64(2)).astype(np.int64) + NAMELESS
    return np.where(doc_id.is_null().to_numpy(zero_copy_only=False), lost, doc_id.fill_null(0).to_numpy())


def linked(s: np.ndarray, t: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(s, t, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(s) + len(t) - both)


def verified(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b), stored, whose whole sets are similar enough; other columns stay."""
    names = [f.name for f in pairs.schema]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text_a"):
                both = zip(sets_of(piece.column("text_a")).each(), sets_of(piece.column("text_b")).each(), strict=True)
                yield piece.select(names).filter(pa.array([linked(s, t, percent) for s, t in both], pa.bool_()))

    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    texts = texts_of(docs, ends)
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select(*names, "text_a", "text_b").mapInArrow(run, fields)


def bits_of(sets: Sets) -> pa.Array:
    """The parity bits of each set: a power of two of bits, ``BITS_EACH`` for each shingle at least, in
    which a shingle flips the bit of its hash."""
    width = np.array([bits_for(n) for n in sets.size.tolist()], np.int64)
    first = np.cumsum(width) - width
    at = first[sets.row] + (mix(sets.item) & (width[sets.row] - 1).astype(U64)).astype(np.int64)
    odd = np.bincount(at, minlength=int(width.sum())) & 1
    body = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    edge = np.concatenate((first, [width.sum()])) // 8
    return pa.array([body[edge[i] : edge[i + 1]] for i in range(len(width))], pa.binary())


def with_bits(texts: DataFrame) -> DataFrame:
    """node, n and the parity bits of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch):
                sets = sets_of(piece.column("text"))
                columns = [piece.column("node"), pa.array(sets.size, pa.int64()), bits_of(sets)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n", "bits"])

    return texts.select("node", "text").mapInArrow(run, "node bigint, n bigint, bits binary")


def bits_for_nodes(found: DataFrame, wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """node, n and bits of the wanted nodes, from the rows of ``measured``."""
    node = F.coalesce("doc_id", nameless(F.col("lo"))).alias("node")
    own = joined_small(found.filter("choice IS NULL").select(node, "n", "hi", "lo", "bits"), wanted, ["node"])
    apart = (F.min("hi") < F.max("hi")) | (F.min("lo") < F.max("lo"))
    bits = stored(own.groupBy("node").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), apart.alias("several")), "bits")
    one, several = bits.filter("NOT several").drop("several"), bits.filter("several").select("node")
    if several.isEmpty():
        return one
    # rows of one id differ: the first text stands for it, as in verification
    return stored(one.union(with_bits(texts_of(docs, several))), "bits")


def bits_for(n: int) -> int:
    return max(64, 1 << (BITS_EACH * n - 1).bit_length())


def folded(bits: bytes, width: int) -> np.ndarray:
    """A bit vector of ``width`` bits from a longer one: parities of its parts."""
    words = np.frombuffer(bits, np.uint64)
    return np.bitwise_xor.reduce(words.reshape(-1, width // 64), axis=0)


def possible(pairs: DataFrame, bits: DataFrame, bands: Bands) -> DataFrame:
    """The pairs (a, b) that their sizes and bits leave open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, x, y = (batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b"))
            near = []
            for i in range(batch.num_rows):
                width = 8 * min(len(x[i]), len(y[i]))
                apart = np.bitwise_count(folded(x[i], width) ^ folded(y[i], width)).sum()
                near.append(bool(apart <= bands.differ(n[i] + m[i])))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    side = lambda name: bits.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))
    fit = f"100 * least(n_a, n_b) >= {bands.percent} * greatest(n_a, n_b)"
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(fit).mapInArrow(run, "a bigint, b bigint")


def candidates(left: list[tuple], right: list[tuple], bands: Bands) -> list[tuple[int, int, bool]]:
    """Pairs of nodes of different classes, among ``left`` if ``right`` is empty, that may be linked by
    their sizes and bits, and whether it is the nearest pair of its two classes here."""
    both = [*left, *right]
    node, mark, n = (np.array([x[i] for x in both], np.int64) for i in range(3))
    width = bits_for(int(n.min()))
    table = np.stack([folded(x[3], width) for x in both])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    found = []
    for i in range(len(left)):
        j = np.arange(len(left), len(both)) if right else np.arange(i + 1, len(both))
        fit = (mark[j] != mark[i]) & (100 * np.minimum(n[i], n[j]) >= bands.percent * np.maximum(n[i], n[j]))
        j = j[fit]
        apart = np.bitwise_count(table[i] ^ table[j]).sum(axis=1).astype(np.int64)
        near = apart <= bands.differ(n[i] + n[j])
        for x, d in zip(j[near].tolist(), apart[near].tolist(), strict=True):
            pair = (min(mark[i], mark[x]), max(mark[i], mark[x]))
            if pair not in best or d < best[pair][0]:
                best[pair] = (d, i, x)
            found.append((i, x))
    first = {(i, x) for _, i, x in best.values()}
    return [(int(min(node[i], node[x])), int(max(node[i], node[x])), (i, x) in first) for i, x in found]


def across(named: DataFrame, bits: DataFrame, bands: Bands) -> DataFrame:
    """Pairs (a, b, first) of nodes of different classes that meet under a key and pass the bits.

    named has key, centre, node and class, bits the node's n and bits. Pairs with the centre of a
    key are verified already, so the centre is left out; of keys with the same other nodes one is enough.
    """
    named = named.filter("node <> centre")
    mark = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"x{i}") for i in (1, 2)]
    mixed = named.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("size"), *mark).filter("low < high")
    mixed = mixed.groupBy("size", "x1", "x2").agg(F.min("key").alias("key")).select("key")
    held = stored(named.join(mixed, "key").join(bits, "node").select("key", "node", "class", "n", "bits"), "meeting")
    weight = F.greatest(F.length("bits"), F.lit(BLOCK_BYTES // BLOCK_NODES))
    counts = held.groupBy("key").agg(F.ceil(F.sum(weight) / BLOCK_BYTES).cast("bigint").alias("blocks"))
    counts = stored(counts, "keys")
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = joined_small(held, counts, ["key"]).withColumn("block", block)
    sets = F.collect_list(F.struct("node", "class", "n", "bits")).alias("sets")
    tasks = 4 * shuffle_width(named.sparkSession)  # few bytes but much work: a given number of tasks is not merged
    # the sets of a key with one block are compared where they meet
    whole = dealt.filter("blocks = 1").repartition(tasks, "key").groupBy("key").agg(sets)
    whole = whole.select(F.col("sets").alias("left"), F.slice("sets", 1, 0).alias("right"))
    blocks = stored(dealt.filter("blocks > 1").groupBy("key", "block").agg(sets), "blocks")
    every = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    pairs = counts.filter("blocks > 1").select("key", F.explode(every).alias("i"), "blocks")
    pairs = pairs.select("key", "i", F.explode(F.sequence("i", F.col("blocks") - 1)).alias("j"))
    pairs = pairs.repartition(tasks, "key", "i", "j")
    side = lambda name: blocks.select("key", F.col("block").alias(name), F.col("sets").alias(f"sets_{name}"))
    met = pairs.join(side("i"), ["key", "i"]).join(side("j"), ["key", "j"])
    right = F.when(F.col("i") == F.col("j"), F.array()).otherwise(F.col("sets_j"))
    met = whole.union(met.select(F.col("sets_i").alias("left"), right.alias("right")))

    # rows are large: they go to Python in batches by their number, some 100
    @F.udf(returnType="array<struct<a:bigint,b:bigint,first:boolean>>", useArrow=False)
    def compare(left, right):
        return candidates(left, right, bands)

    found = met.select(F.explode(compare("left", "right")).alias("x")).select("x.*")
    return found.groupBy("a", "b").agg(F.max("first").alias("first"))


def components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    docs = docs.select("doc_id", "text")
    bands = Bands.of(percent)
    found = stored(measured(docs, bands), "sets")
    marks = found.filter("choice IS NULL").select("doc_id", "n", "hi", "lo", "band")
    same = marks.filter("n > 0").groupBy("hi", "lo", "band").agg(F.count("*").alias("c"), F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("lost"))
    same = stored(same.filter("c > 1 OR lost"), "equal-sets")
    in_band = marks.filter("n > 0").groupBy("band").agg(F.count("*").alias("documents"))
    more = same.groupBy("band").agg(F.sum(F.col("c") * (F.col("c") - 1)).alias("more"))
    equal = F.col("documents") + F.coalesce("more", F.lit(0))
    chosen = allocation(found, in_band.join(more, "band", "left").select("band", "documents", equal.alias("equal")), bands)

    # equal sets are one node, the smallest id of them
    first = same.filter("first IS NOT NULL").select("hi", "lo", "first")
    named = joined_small(marks, first, ["hi", "lo"], "left")
    node = F.when(F.col("doc_id").isNull(), nameless(F.col("lo"))).otherwise(F.coalesce("first", "doc_id"))
    named = named.select("doc_id", "n", node.alias("node"))
    later = stored(named.filter("doc_id <> node").select("doc_id"), "copies")
    single = joined_small(docs, later, ["doc_id"], "left_anti")

    keys = stored(keyed(single, bands, chosen), "keys")
    members = stored(members_of(keys), "members")
    wanted = stored(members.select("node").distinct(), "nodes")
    bits = bits_for_nodes(found, wanted, docs)

    tested = members.filter("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    tested = stored(possible(tested, bits, bands), "tested")
    own = same.filter("lost AND first IS NOT NULL").select(nameless(F.col("lo")).alias("a"), F.col("first").alias("b"))
    links = stored(verified(tested, docs, percent).union(own), "links")
    label = connected(links)

    def classed(df: DataFrame, node: str, name: str = "class") -> DataFrame:
        found = label.select(F.col("node").alias("_node"), F.col("class").alias("_class"))
        return df.join(found, F.col(node) == F.col("_node"), "left").withColumn(name, F.coalesce("_class", node)).drop("_node", "_class")

    named_members = classed(members, "node")
    met = stored(across(named_members, bits, bands), "candidates")
    for some in (met.filter("first"), met.filter("NOT first")):
        apart = classed(classed(some.select("a", "b"), "a", "of_a"), "b", "of_b").filter("of_a <> of_b").select("a", "b")
        apart = stored(apart, "apart")
        if apart.isEmpty():
            continue
        new = stored(verified(apart, docs, percent), "links")
        if not new.isEmpty():
            label = connected(label.select(F.col("node").alias("a"), F.col("class").alias("b")).union(new))
    label = stored(label, "components")
    out = joined_small(named, label, ["node"], "left")
    whole = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("class", "node"))
    whole = F.when(whole < NAMELESS, whole)
    return out.select("doc_id", F.col("n").alias("n_shingles"), whole.alias("component_id"))
