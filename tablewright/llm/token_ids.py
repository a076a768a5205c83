"""Token ids in frequency-ranked, byte-aligned, variable-length files.

Ids are replaced by their frequency rank over all documents, so that the common ones need
one byte. A rank takes 1 to 4 bytes, little-endian; two bits per rank give its length, four
of them in a control byte, and control bytes stand apart from the data bytes. Decoding looks
each control byte up in a table of byte masks: one numpy assignment puts all data bytes in
their places.

Files. `tokens` has one row per block of consecutive documents: shard, block, the ids and
lengths of its documents, its number of ids, the number of ids before it in its shard,
control bytes and data bytes. Shards follow each other in ascending doc_id order, and so do
blocks and documents in them. `ranks` has the id of each rank; its size is bounded by the
vocabulary.

Every text is tokenized once. Texts are cut where the tokenizer's own splitting rule always
cuts (before a single space and around a single line end, between printing characters), and
each distinct piece is given to the tokenizer once per worker while it is remembered; a
text with any other white space or control character, or a special token's name, is given
to it whole.

Null and empty texts have the end id only. Null doc_ids come first; rows with equal ids are
ordered by a hash of their ids. Repeated rows are stored as often as they occur.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.tables import pieces, shuffle_width, stored
from tablewright.llm.textkit import slices, sums
from tablewright.session import fresh_folder

END_ID = 0
BLOCK_IDS = 1 << 20
PART_BYTES = 16 << 20
MEMORY = 1_000_000
SLICE_BYTES = 8 << 20
TOGETHER = 10_000

LENGTHS = np.array([[1 + (c >> 2 * i & 3) for i in range(4)] for c in range(256)], np.int64)
MASKS = (np.arange(4)[None, None, :] < LENGTHS[:, :, None]).reshape(256, 16)

FILE = (
    "shard int, block int, docs array<bigint>, lengths array<bigint>, n_ids bigint, before bigint, control binary, data binary"
)
RESULT = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def packed(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = extra
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4)[None, :] <= extra[:, None]]
    return control.tobytes(), data.tobytes()


def unpacked(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks again. Ranks that only fill the last control byte take one byte each."""
    mask = MASKS[np.frombuffer(control, np.uint8)]
    out = np.zeros(mask.shape, np.uint8)
    body = np.frombuffer(data, np.uint8)
    out[mask] = np.concatenate((body, np.zeros(int(mask.sum()) - len(body), np.uint8)))
    return out.view("<u4").ravel()[:n]


class Pieces(dict):
    """Piece of text -> its ids as bytes; asks the tokenizer for the pieces it has not seen."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def learn(self, names: list[str]) -> None:
        """Ids of the pieces not yet known, which go to the tokenizer together; None for a piece
        that only occurs in texts to be taken whole."""
        new = [x for x in names if x not in self]
        if len(self) + len(new) > MEMORY:
            self.clear()
            new = names
        good = [x for x in new if x == "\n" or x.strip(" ") and x.isprintable()]
        self.update(dict.fromkeys(new))
        if "\n" in good:
            good.remove("\n")
            self["\n"] = self.ids("\n")
        for at in range(0, len(good), TOGETHER):
            some = good[at : at + TOGETHER]
            self.update(zip(some, self.apart(some), strict=True))

    def apart(self, names: list[str]) -> list[bytes]:
        """Ids of each piece. All are one text, a piece a line: the tokenizer cuts there too, and
        the id of the line end, which no piece holds, separates them."""
        mark = self.tokenizer.encode("\n", add_special_tokens=False).ids
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(names)], add_special_tokens=False)[0].ids, self.code)
        at = np.flatnonzero(ids == mark[0]) if len(mark) == 1 else []
        if len(at) != len(names) - 1:  # a tokenizer that treats line ends in another way
            return [self.ids(x) for x in names]
        blob, width = ids.tobytes(), ids.itemsize
        at = (at * width).tolist()
        return [blob[a:b] for a, b in zip([0, *(x + width for x in at)], [*at, len(blob)], strict=True)]

    def encoded(self, column: pa.Array) -> pa.Array:
        """Ids of each text as bytes. Texts are cut, and ids put together, for all texts at once."""
        column = pc.fill_null(column, "")
        whole = pc.match_substring(column, "\0").to_numpy(zero_copy_only=False)
        for name in self.special:
            whole = whole | pc.match_substring(column, name).to_numpy(zero_copy_only=False)
        marked = pc.replace_substring(pc.replace_substring(column, " ", "\0 "), "\n", "\0\n\0")
        cut = pc.split_pattern(marked, "\0")
        coded = cut.flatten().dictionary_encode()
        ends = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        codes = coded.indices.to_numpy()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(names)
        known = [self[x] for x in names]
        unusual = np.array([x is None for x in known], bool)
        whole = whole | (sums(unusual[codes], ends) > 0)
        flat = np.frombuffer(b"".join(x for x in known if x is not None), self.code)
        sizes = np.array([len(x or b"") for x in known], np.int64) // flat.itemsize
        counts = sizes[codes]
        counts[np.repeat(whole, np.diff(ends))] = 0
        shift = (np.cumsum(sizes) - sizes)[codes] - (np.cumsum(counts) - counts)
        ids = flat[np.repeat(shift, counts) + np.arange(counts.sum())]
        offsets = np.concatenate(([0], np.cumsum(sums(counts, ends)))) * flat.itemsize
        found = pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]).cast(pa.binary())
        if not whole.any():
            return found
        ids_of_all = found.to_pylist()
        for i in np.flatnonzero(whole).tolist():
            ids_of_all[i] = self.ids(column[i].as_py())
        return pa.array(ids_of_all, pa.binary())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.encoded(pa.array(texts, pa.string())).to_pylist()


_PIECES: dict[str, Pieces] = {}


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (two bytes each, four for a large vocabulary, without the end id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _PIECES:
            _PIECES[path] = Pieces(path)
        pieces = _PIECES[path]
        width = array(pieces.code).itemsize
        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES):
                ids = pieces.encoded(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array([width] * len(ids), pa.int32()), ids], ["doc_id", "width", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, width int, ids binary")


def ids_of(width: int, ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, f"<u{width}").astype(np.int64)


def frequencies(tokens: DataFrame) -> DataFrame:
    """id and how often it occurs, end ids too; at most as many rows as the vocabulary has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            widths = batch.column("width").to_pylist()
            for width in set(widths):
                all_ids = np.frombuffer(b"".join(x for x, w in zip(batch.column("ids").to_pylist(), widths, strict=True) if w == width), f"<u{width}")
                found = np.bincount(all_ids, minlength=len(total))
                found[: len(total)] += total
                total = found
            total[END_ID] += batch.num_rows
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    return tokens.select("width", "ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, tokenizer: str, folder: str, part_bytes: int = PART_BYTES, block_ids: int = BLOCK_IDS) -> None:
    """Tokenize the texts of ``docs`` and write `folder`/ranks and `folder`/tokens."""
    spark = docs.sparkSession
    tokens = stored(tokenized(docs, tokenizer), "ids")
    ranked = [r["id"] for r in frequencies(tokens).orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame([(k, i) for k, i in enumerate(ranked)], "rank int, id bigint").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank_of[ranked] = np.arange(len(ranked))
    shared = spark.sparkContext.broadcast(rank_of)  # as many as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        docs, parts, held = [], [], 0

        def flushed() -> pa.RecordBatch:
            lengths = [len(p) for p in parts]
            control, data = packed(shared.value[np.concatenate(parts)])
            row = {"shard": shard, "block": block, "docs": docs, "lengths": lengths, "n_ids": held, "before": before, "control": control, "data": data}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for doc, width, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "width", "ids")), strict=True):
                docs.append(doc)
                parts.append(np.append(ids_of(width, ids), END_ID))
                held += len(parts[-1])
                if held >= block_ids:
                    yield flushed()
                    block, before, docs, parts, held = block + 1, before + held, [], [], 0
        if docs:
            yield flushed()

    longs, ints = pa.int64(), pa.int32()
    schema = pa.schema([("shard", ints), ("block", ints), ("docs", pa.list_(longs)), ("lengths", pa.list_(longs)), ("n_ids", longs), ("before", longs), ("control", pa.binary()), ("data", pa.binary())])
    n = pieces(tokens, F.octet_length("ids") + 16, part_bytes, shuffle_width(spark))
    tie = F.xxhash64("ids")
    ordered = tokens.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    ordered.mapInArrow(run, FILE).write.parquet(f"{folder}/tokens")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: its place in the whole sequence, number and crc32 of its ids."""
    files = spark.read.parquet(f"{folder}/tokens")
    ranked = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()
    ids = spark.sparkContext.broadcast(np.array([r["id"] for r in ranked], np.int64))
    # one row per shard
    totals = {r["shard"]: r["n"] for r in files.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    base, start = {}, 0
    for shard in sorted(totals):
        base[shard], start = start, start + totals[shard]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                found = ids.value[unpacked(row["control"], row["data"], row["n_ids"])].astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                view = memoryview(found)
                crc = [zlib.crc32(view[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["docs"], pa.int64()), pa.array(starts + row["before"] + base[row["shard"]]), pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.mapInArrow(run, RESULT)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` to a new folder and report what the files hold."""
    folder = fresh_folder(docs.sparkSession, "token-ids")
    write(docs, tokenizer, folder)
    return read(docs.sparkSession, folder)
