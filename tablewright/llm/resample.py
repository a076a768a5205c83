"""Target-distribution importance resampling with hashed n-grams.

Documents are drawn as if from the distribution of a target collection: features, all runs of
one to ``RUN`` consecutive words, fall into ``BUCKETS`` buckets by their CRC-32; a bucket's gain
is the log ratio of its smoothed shares in target and documents; a document's weight is the
mean gain of its features, and a Gumbel draw seeded by the doc_id turns the best scores into
a sample without replacement.

CRC by position tables. CRC-32 is linear: a byte adds a value that depends on nothing but
itself and its distance from the end of the span, and all spans of one length share a
constant. ``PLACES`` holds these values for ``NEAR`` distances, so the checksums of all features
of a batch of texts are one table lookup and one `bitwise_xor.reduceat` over the spans. A longer
span is folded blockwise: its blocks, counted from the end, are looked up alike, and
neighbours are merged by the matrix that appends so many zero bytes, twice as many at each
turn.

Two passes read the texts. The first leaves counts by bucket, at most ``BUCKETS`` from each
partition; these go to the driver. The second leaves a narrow row for each document. Ranks
come from a range partitioning of the scores that can be drawn, numbered within each
partition; nothing is ordered in one task. Scores are whole thousandths of a logarithm, so
the counts by score that give the cut are some 100,000 at most, for any number of rows.

Defined cases: a null text has no words; a document without words weighs 0; fewer than
``LEAST_WORDS`` words are never drawn. A null doc_id is drawn like the id '' and comes last
among equal scores. Repeated rows each take part, in the order in which they are stored. An
empty table gives no rows, an empty target makes common features cheap and rare ones dear.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.tables import stored
from tablewright.llm.textkit import ALNUM, LOWER, Runs, buffer_of, slices

RUN = 2
BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = 25
SEED = 7
NEAR = 128
CHUNK_BYTES = 1 << 17
LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above these bits
FULL = np.uint32(0xFFFFFFFF)


def _places() -> np.ndarray:
    """What a byte adds to the checksum at each distance from the end, [distance, byte]."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    out = np.empty((NEAR, 256), np.uint32)
    out[0] = table
    for d in range(1, NEAR):
        out[d] = table[out[d - 1] & 0xFF] ^ (out[d - 1] >> 8)
    return out


PLACES = _places()


@cache
def zeros_after(power: int) -> np.ndarray:
    """The columns of the matrix that appends 2^power zero bytes to a checksum's register."""
    if power:
        half = zeros_after(power - 1)
        return moved(half, half)
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    return PLACES[0][bits & 0xFF] ^ (bits >> np.uint32(8))


def moved(values: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The matrix applied to each register."""
    out = np.zeros_like(values)
    for bit in range(32):
        out ^= np.where(values >> np.uint32(bit) & np.uint32(1), matrix[bit], np.uint32(0))
    return out


def of_zeros(lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of so many zero bytes: the constant of each length."""
    value = np.full(len(lengths), FULL, np.uint32)
    for power in range(int(lengths.max(initial=0)).bit_length()):
        value = np.where(lengths >> power & 1, moved(value, zeros_after(power)), value)
    return value ^ FULL


NEAR_CONSTANTS = of_zeros(np.arange(NEAR + 1))


def _lookup(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """What the bytes of spans of 1 to ``NEAR`` bytes add to their checksums."""
    lengths = end - begin
    past = np.cumsum(lengths)
    step = np.arange(past[-1], dtype=np.int32)
    at = step + np.repeat((end - past).astype(np.int32), lengths)
    cell = (np.repeat(past.astype(np.int32), lengths) - step - 1) << 8
    return np.bitwise_xor.reduceat(PLACES.ravel().take(cell + data.take(at)), past - lengths)


def _folded(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The same for longer spans, block by block."""
    blocks = -(-(end - begin) // NEAR)
    first = np.cumsum(blocks) - blocks
    owner = np.repeat(np.arange(len(blocks)), blocks)
    number = np.arange(int(blocks.sum())) - first[owner]  # from the end of the span
    stop = end[owner] - number * NEAR
    value = _lookup(data, np.maximum(stop - NEAR, begin[owner]), stop)
    power = NEAR.bit_length() - 1
    while len(value) > len(blocks):
        left = np.flatnonzero(number % 2)  # merged with the block after it in the text, one index below
        value[left - 1] ^= moved(value[left], zeros_after(power))
        stay = number % 2 == 0
        value, number, power = value[stay], number[stay] // 2, power + 1
    return value


def span_crcs(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of the bytes of every span, which may overlap; none is empty."""
    out = np.zeros(len(begin), np.uint32)
    lengths = end - begin
    near = lengths <= NEAR
    upto = np.cumsum(np.where(near, lengths, 0))
    edges = np.unique(np.searchsorted(upto, np.arange(0, int(upto[-1]) + CHUNK_BYTES, CHUNK_BYTES))) if len(upto) else []
    for i, j in zip(edges, [*edges[1:], len(out)], strict=True):
        some = np.flatnonzero(near[i:j]) + i
        if len(some):
            out[some] = _lookup(data, begin[some], end[some]) ^ NEAR_CONSTANTS[lengths[some]]
    far = np.flatnonzero(~near)
    for i in far[lengths[far] > CHUNK_BYTES]:
        out[i] = _folded(data, begin[i : i + 1], end[i : i + 1])[0]
    some = far[lengths[far] <= CHUNK_BYTES]
    turn = np.cumsum(lengths[some]) // CHUNK_BYTES
    for t in np.unique(turn):
        part = some[turn == t]
        out[part] = _folded(data, begin[part], end[part])
    out[far] ^= of_zeros(lengths[far])
    return out


def features(column: pa.Array, run: int = RUN, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every feature, text by text, and how many each text has."""
    words = Runs(*buffer_of(column), ALNUM)
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(column), np.int64)
    lengths = words.ends - words.starts
    begin = np.cumsum(lengths + 1) - lengths - 1
    flat = np.full(int(lengths.sum()) + n, 0x20, np.uint8)  # words joined by one space
    inner = LOWER[words.data[words.inside]]
    flat[np.arange(len(inner)) + np.repeat(np.arange(n), lengths)] = inner
    end = begin + lengths
    last = np.repeat(words.first[1:], words.counts)  # past the last word of a word's text
    start = [np.flatnonzero(np.arange(n) + k < last) for k in range(run)]
    index = np.concatenate(start)
    stop = np.concatenate([end[s + k] for k, s in enumerate(start)])
    order = np.argsort(words.row[index], kind="stable")
    crc = span_crcs(flat, begin[index[order]], stop[order])
    return (crc % np.uint32(buckets)).astype(np.int64), np.bincount(words.row[index], minlength=len(column))


def bucket_counts(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in slices(batch, "text"):
                total += np.bincount(features(piece.column("text"), run, buckets)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(count, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = found.toArrow()  # a row for each bucket at most
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's share in the target and in the documents."""
    have, want = bucket_counts(docs, run, buckets), bucket_counts(target, run, buckets)
    total, aim = float(have.sum()), float(want.sum())
    ratio = ((t + 1.0) * (total + buckets) / ((s + 1.0) * (aim + buckets)) for s, t in zip(have.tolist(), want.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def draw_of(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel draw that depends on the document's id only."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def scored(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``docs``, all columns, with n_features, weight and score; columns of these names are replaced."""
    gain = gains(docs, target, run, buckets)
    keep = [c for c in docs.columns if c not in ("n_features", "weight", "score")]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                bucket, n = features(piece.column("text"), run, buckets)
                upto = np.concatenate(([0], np.cumsum(gain[bucket])))
                edge = np.concatenate(([0], np.cumsum(n)))
                weight = (upto[edge[1:]] - upto[edge[:-1]]) // np.maximum(n, 1)
                columns = [*[piece.column(c) for c in keep if c in given], pa.array(n, pa.int64()), pa.array(weight, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [*[c for c in keep if c in given], "n_features", "weight"])

    rows = docs.select(*keep)
    given = set(keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    out = rows.mapInArrow(weigh, f"{fields}, n_features bigint, weight bigint")
    return out.withColumn("score", F.col("weight") + draw_of(F.col("doc_id"), seed))


def least_features(words: int, run: int) -> int:
    """Features of a text of so many words."""
    return sum(max(0, words - k) for k in range(run))


def ranked(rows: DataFrame, share: int = SHARE, words: int = LEAST_WORDS, run: int = RUN) -> DataFrame:
    """Stored rows with doc_id, n_features and score, and their rank among the drawn ones, else null."""
    fit = F.col("n_features") >= least_features(words, run)
    counts = rows.filter(fit).groupBy("score").count().toArrow().sort_by([("score", "descending")])
    wanted = share * sum(counts.column("count").to_pylist()) // 100
    upto = np.cumsum(counts.column("count").to_numpy())
    none = F.lit(None).cast("bigint")
    if not wanted:
        return rows.withColumn("rank", none)
    cut = int(counts.column("score")[int(np.searchsorted(upto, wanted))].as_py())
    able = fit & (F.col("score") >= cut)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    laid = rows.filter(able).withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    laid = stored(laid.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    laid = laid.withColumn("_part", F.shiftright("_at", LOCAL_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    offsets = laid.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << LOCAL_BITS) - 1) + 1
    top = laid.join(F.broadcast(offsets), "_part").withColumn("rank", F.when(place <= wanted, place))
    return top.select(*rows.columns, "rank").union(rows.filter(~able).withColumn("rank", none))


def resampled(docs: DataFrame, target: DataFrame, share: int = SHARE) -> DataFrame:
    """One narrow row per document: doc_id, n_features, weight, score, rank (null if not drawn)."""
    return ranked(stored(scored(docs.select("doc_id", "text"), target).drop("text"), "scores"), share)


def drawn(docs: DataFrame, target: DataFrame, share: int = SHARE) -> DataFrame:
    """The drawn rows of ``docs``, all columns, with n_features, weight, score and rank in place of
    columns of these names."""
    rows = stored(scored(docs.drop("rank"), target), "scored")
    return ranked(rows, share).filter(F.col("rank").isNotNull())
