"""Exact substring dedup over fixed-block anchors.

A window is ``WINDOW`` consecutive words `[^\\x20\\x09-\\x0D]+` of one document. A word goes if a
window that covers it also starts in a document with a smaller id.

1. Anchors. Every text is cut into non-overlapping blocks of ``BLOCK`` words; any window
   holds at least one whole block of its own document. These blocks are the index. Every
   rolling block of every text probes it. A block is shared if it is in the index and
   stands in two documents.
2. Extension. Around the shared blocks, every window is hashed, and per hash the smallest
   id is found. Overlapping windows that start in a smaller document make up the maximal
   exact repeats.

Documents lie in parts of bounded bytes, each handled by one task at a time. A part sends
each distinct hash once, however often it occurs, so a passage or a text that a third of all
rows share costs a row per part, not per occurrence. Hashes travel packed, dealt to buckets
by their high bits; a bucket holds a bounded share of them. The texts are shuffled once and
the three passes read the same shuffle files. Probes carry 32 bits within a bucket; a clash
there only adds a candidate. Windows carry 64 bits within a bucket.

Null and empty texts have no words. A null id counts as larger than any other. Rows with the
same id do not remove each other's words; repeated rows each get their own result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.tables import pieces, shuffle_width
from tablewright.llm.textkit import PLAIN, Runs, buffer_of, covered, grouped, slices, window_hashes, window_starts

WINDOW = 50
BLOCK = 25
PART_BYTES = 6 << 20
BUCKET_BYTES = 128 << 20
NO_ID = np.iinfo(np.int64).max

MESSAGE = "bucket bigint, part bigint, keys binary, extra binary"
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
_MESSAGE_TYPES = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("keys", pa.binary()), ("extra", pa.binary())])


class Part:
    """Word hashes of all texts of a part, in one array."""

    def __init__(self, texts: pa.Table):
        ids = pc.fill_null(texts.column("doc_id"), NO_ID).combine_chunks().to_numpy(zero_copy_only=False)
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in texts.select(["text"]).to_batches():
            for piece in slices(batch, "text"):
                runs = Runs(*buffer_of(piece.column("text")), PLAIN)
                hashes.append(runs.hashes())
                counts.append(runs.counts)
        self.hashes = np.concatenate(hashes)
        self.counts = np.concatenate(counts)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        self.ids = np.repeat(ids, self.counts)
        self.place = np.arange(len(self.hashes)) - np.repeat(self.first[:-1], self.counts)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all windows of ``width`` words."""
        starts = window_starts(self, width)
        return starts, window_hashes(self.hashes, width)[starts] if len(starts) else np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.hashes)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(32)) % np.uint64(buckets)


def packed(part: int, buckets: np.ndarray, keys: np.ndarray, extra: np.ndarray) -> pa.Table:
    """One message per bucket with its keys and what belongs to each."""
    order = np.argsort(buckets, kind="stable")
    buckets, keys, extra = buckets[order], keys[order], extra[order]
    names, first = np.unique(buckets, return_index=True)
    ends = [*first[1:].tolist(), len(keys)][: len(names)]
    rows = list(zip(names.tolist(), first.tolist(), ends, strict=True))
    return pa.Table.from_arrays(
        [
            pa.array([b for b, _, _ in rows], pa.int64()),
            pa.array([part] * len(rows), pa.int64()),
            pa.array([keys[i:j].tobytes() for _, i, j in rows], pa.binary()),
            pa.array([extra[i:j].tobytes() for _, i, j in rows], pa.binary()),
        ],
        schema=_MESSAGE_TYPES,
    )


def unpacked(messages: pa.Table, key_type: str, extra_type: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys = [np.frombuffer(x, key_type) for x in messages.column("keys").to_pylist()]
    extra = [np.frombuffer(x, extra_type) for x in messages.column("extra").to_pylist()]
    parts = np.repeat(messages.column("part").to_numpy(), [len(k) for k in keys])
    return np.concatenate([np.zeros(0, key_type), *keys]), np.concatenate([np.zeros(0, extra_type), *extra]), parts


def probes(part: int, texts: pa.Table, buckets: int) -> pa.Table:
    """Each distinct rolling block of a part. Bit 1: it is an index block; bit 2: it stands
    in two documents of the part."""
    words = Part(texts)
    starts, hashes = words.windows(BLOCK)
    order, new = grouped(hashes)
    first = np.flatnonzero(new)
    flags = np.zeros(len(first), np.uint8)
    if len(first):
        ids = words.ids[starts][order]
        indexed = (words.place[starts] % BLOCK == 0)[order]
        flags = np.logical_or.reduceat(indexed, first) | (np.minimum.reduceat(ids, first) < np.maximum.reduceat(ids, first)).astype(np.uint8) << 1
    distinct = hashes[order][new]
    return packed(part, bucket_of(distinct, buckets), distinct.astype(np.uint32), flags.astype(np.uint8))


def shared_blocks(bucket: int, messages: pa.Table) -> pa.Table:
    """Back to each part: its blocks that are in the index and stand in two documents."""
    keys, flags, parts = unpacked(messages, "<u4", "u1")
    order, new = grouped(keys)
    first = np.flatnonzero(new)
    flags, parts, keys = flags[order], parts[order], keys[order]
    held = np.bitwise_or.reduceat(flags, first)
    size = np.diff(np.append(first, len(keys)))
    chosen = np.repeat((held & 1 > 0) & ((size > 1) | (held & 2 > 0)), size)
    return by_part(bucket, parts[chosen], keys[chosen])


def by_part(bucket: int, parts: np.ndarray, keys: np.ndarray) -> pa.Table:
    out = []
    order = np.argsort(parts, kind="stable")
    names, first = np.unique(parts[order], return_index=True)
    for name, chosen in zip(names.tolist(), np.split(keys[order], first[1:]), strict=False):
        out.append({"bucket": bucket, "part": name, "keys": chosen.tobytes(), "extra": b""})
    return pa.Table.from_pylist(out, schema=_MESSAGE_TYPES)


def member(hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which hashes are in the sorted ``wanted``."""
    if not len(wanted):
        return np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
    return wanted[at] == hashes


def candidates(part: int, texts: pa.Table, shared: pa.Table, buckets: int) -> pa.Table:
    """The windows around shared blocks, each distinct hash once with its smallest id."""
    words = Part(texts)
    starts, hashes = words.windows(BLOCK)
    shift = np.uint64(32)
    wanted = [(np.uint64(b) << shift) | np.frombuffer(k, "<u4").astype(np.uint64) for b, k in zip(shared.column("bucket").to_pylist(), shared.column("keys").to_pylist(), strict=True)]
    wanted = np.sort(np.concatenate([np.zeros(0, np.uint64), *wanted]))
    hits = starts[member((bucket_of(hashes, buckets) << shift) | (hashes & np.uint64(0xFFFFFFFF)), wanted)]
    reach = WINDOW - BLOCK
    begin = np.maximum(hits - reach, 0)
    near = covered(begin, hits + 1 - begin, len(words))
    starts, hashes = words.windows(WINDOW)
    chosen = near[starts]
    starts, hashes = starts[chosen], hashes[chosen]
    order, new = grouped(hashes)
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(words.ids[starts][order], first) if len(first) else np.zeros(0, np.int64)
    distinct = hashes[order][new]
    return packed(part, bucket_of(distinct, buckets).astype(np.int64), distinct, least)


def later_windows(bucket: int, messages: pa.Table) -> pa.Table:
    """Back to each part: its windows that start in a smaller document of another part."""
    keys, ids, parts = unpacked(messages, "<u8", "<i8")
    order, new = grouped(keys)
    first = np.flatnonzero(new)
    keys, ids, parts = keys[order], ids[order], parts[order]
    least = np.repeat(np.minimum.reduceat(ids, first), np.diff(np.append(first, len(keys))))
    return by_part(bucket, parts[least < ids], keys[least < ids])


def kept_words(texts: pa.Table, later: pa.Table) -> pa.Table:
    """Words, removed words and the hash of the kept words of each text of a part."""
    words = Part(texts)
    starts, hashes = words.windows(WINDOW)
    keys = [np.frombuffer(x, "<u8") for x in later.column("keys").to_pylist()]
    gone = member(hashes, np.sort(np.concatenate([np.zeros(0, np.uint64), *keys])))
    order, new = grouped(hashes)
    first = np.flatnonzero(new)
    if len(first):
        ids = words.ids[starts][order]
        least = np.repeat(np.minimum.reduceat(ids, first), np.diff(np.append(first, len(ids))))
        gone[order] |= least < ids
    removed = covered(starts[gone], WINDOW, len(words))
    n_removed = np.diff(np.concatenate(([0], np.cumsum(removed)))[words.first])
    digests, done = [], 0
    for batch in texts.select(["text"]).to_batches():
        for piece in slices(batch, "text"):
            runs = Runs(*buffer_of(piece.column("text")), PLAIN)
            keep = ~removed[done : done + len(runs)]
            done += len(runs)
            lengths = (runs.ends - runs.starts)[keep] + 1
            begin = np.cumsum(lengths) - lengths
            body = np.full(int(lengths.sum()), 0x20, np.uint8)
            inner = runs.data[runs.inside][np.repeat(keep, runs.ends - runs.starts)]
            body[np.arange(len(inner)) + np.repeat(np.arange(len(begin)), lengths - 1)] = inner
            edge = np.concatenate((begin, [len(body)]))[np.concatenate(([0], np.cumsum(keep)))[runs.first]].tolist()
            view = memoryview(body)
            digests += [hashlib.sha256(view[i : max(i, j - 1)]).hexdigest() for i, j in zip(edge, edge[1:], strict=False)]
    return pa.Table.from_arrays(
        [texts.column("doc_id").cast(pa.int64()), pa.array(words.counts, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())],
        ["doc_id", "n_words", "n_removed", "kept_sha256"],
    )


def without_repeats(docs: DataFrame, part_bytes: int = PART_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per document: its words, those that a window of a smaller document covers, and the
    hash of the rest."""
    size = F.octet_length("text") + 64
    n_parts = pieces(docs, size, part_bytes, 1)
    buckets = max(shuffle_width(docs.sparkSession), n_parts * part_bytes // bucket_bytes)
    texts = docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(n_parts)).alias("part"))

    asked = texts.groupBy("part").applyInArrow(lambda key, t: probes(key[0].as_py(), t, buckets), MESSAGE)
    shared = asked.groupBy("bucket").applyInArrow(lambda key, t: shared_blocks(key[0].as_py(), t), MESSAGE)
    windows = texts.groupBy("part").cogroup(shared.groupBy("part")).applyInArrow(lambda key, t, m: candidates(key[0].as_py(), t, m, buckets), MESSAGE)
    later = windows.groupBy("bucket").applyInArrow(lambda key, t: later_windows(key[0].as_py(), t), MESSAGE)
    return texts.groupBy("part").cogroup(later.groupBy("part")).applyInArrow(lambda t, m: kept_words(t, m), RESULT)
