"""Texts stored as blocks of numbered tokens, whose n-grams meet in passes.

N-grams of all texts at once take several times the disk of the texts. A text is split into tokens and
stored once instead, in blocks that name each word once; a pass reads the blocks and shuffles only the
n-grams whose hashes are in its range, and its shuffle files go before the next pass begins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import grams
from tablewright.functions import packed as pk
from tablewright.functions import text as tx
from tablewright.functions.batches import pieces
from tablewright.operators.sized import task_count
from tablewright.session import fresh_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: keys that a task gathers before it hands them on, and below which one pass is enough
GATHERED = 1 << 21
#: tokens of the texts, or rows of a model, whose keys one task holds at most
PART = 1 << 22


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action go when it ends, instead of whenever the driver collects its garbage."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class Folder:
    """Tables in a folder of their own, which goes when it is left."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path, self.tables = spark, fresh_folder(spark, label), 0

    def stored(self, df: DataFrame) -> DataFrame:
        self.tables += 1
        return stored(df, f"{self.path}/{self.tables}")

    def __enter__(self) -> Folder:
        return self

    def __exit__(self, *_) -> None:
        sc = self.spark.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path``, without leaving shuffle files, and read back."""
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class Block:
    """Some texts with their keys: ``ids`` are numbers of ``words``, ``sizes`` tokens belong to each text."""

    id: int
    keys: pa.RecordBatch
    sizes: np.ndarray
    ids: np.ndarray
    words: pa.Array


def blocks(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The texts of ``column`` that have tokens, in blocks with the columns ``keys``. Texts are dealt out by
    row first."""
    texts = df.select(*keys, column).repartition(task_count(df)).select(*keys, tx.words(column).alias("_tokens"))
    keys = list(keys)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, grams.sizes_of(batch.column("_tokens"))):
                sizes = grams.sizes_of(part.column("_tokens"))
                held = np.flatnonzero(sizes)
                if not len(held):
                    continue
                tokens = part.column("_tokens").flatten().dictionary_encode()
                columns = [*(part.column(k).take(pa.array(held)) for k in keys), pa.array(sizes[held])]
                row = [
                    pk.packed_rows(pa.RecordBatch.from_arrays(columns, [*keys, "_size"])),
                    pk.packed_numbers(tokens.indices.to_numpy()), pk.packed_words(tokens.dictionary),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(tokens)], pa.int64()), *(pa.array([x], pa.binary()) for x in row)], ["_n", "_texts", "_ids", "_words"]
                )

    return texts.mapInArrow(made, "_n long, _texts binary, _ids binary, _words binary").withColumn("_block", F.monotonically_increasing_id())


@contextmanager
def block_table(df: DataFrame, keys: Sequence[str], column: str, given: DataFrame | None = None) -> Iterator[DataFrame]:
    """``blocks``, stored for as long as they are read, unless ``given``."""
    if given is not None:
        yield given
        return
    with Folder(df.sparkSession, "blocks") as folder:
        yield folder.stored(blocks(df, keys, column))


def words_of(held: DataFrame) -> DataFrame:
    """``word``, once for each block that has it."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            yield pa.RecordBatch.from_arrays([pk.unpacked_words(row["_words"])], ["word"])

    return held.select("_words").mapInArrow(listed, "word string")


def block_of(row: dict) -> Block:
    texts = pk.unpacked_rows(row["_texts"])
    sizes = texts.column("_size").to_numpy()
    return Block(row["_block"], texts, sizes, pk.unpacked_numbers(row["_ids"]), pk.unpacked_words(row["_words"]))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of few, large values."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def tokens_of(held: DataFrame) -> int:
    return held.agg(F.sum("_n").alias("n")).first()["n"] or 0


def parts_of(df: DataFrame, units: int) -> int:
    """Tasks that hold the keys of so many tokens or rows: as many as there are otherwise, or more."""
    return max(task_count(df), -(-units // PART))


# --- distinct keys of groups -------------------------------------------------

Keyed = tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]


def distinct_keys(
    held: DataFrame, keys_of: Callable[[Block], Keyed], group: T.StructType, parts: int, passes: int, number: int
) -> DataFrame:
    """``(group, _unique)``: distinct keys of each group in the range of pass ``number``, in rows that add up.

    ``keys_of`` gives the groups of a block, and of each key its group and both halves.
    """
    names = group.fieldNames()

    def dealt(found: list[Keyed]) -> Iterator[pa.RecordBatch]:
        keys, numbers = numbered_groups([x[0] for x in found])
        g = np.concatenate([n[x[1]] for n, x in zip(numbers, found, strict=True)])
        h1, h2 = (np.concatenate([x[i] for x in found]) for i in (2, 3))
        order, new = pk.sorted_keys(h1, h2, g)
        at = order[new]
        part = pk.part_of(h1[at], parts * passes) % parts
        again = np.lexsort([g[at], part])
        at, part = at[again], part[again]
        for value, low, high in pk.split_by(part):
            here = at[low:high]
            runs = pk.split_by(g[here])
            sizes = pa.array([b - a for _, a, b in runs], pa.int64())
            mine = keys.take(pa.array([x for x, _, _ in runs], pa.int64()))
            texts = pk.packed_rows(pa.RecordBatch.from_arrays([*mine.columns, sizes], [*names, "_size"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], pa.int32()), pa.array([texts], pa.binary()), pa.array([h1[here].tobytes() + h2[here].tobytes()], pa.binary())],
                ["_part", "_groups", "_keys"],
            )

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[Keyed] = []
        for row in rows_of(batches):
            keys, g, h1, h2 = keys_of(block_of(row))
            mine = np.flatnonzero(pk.part_of(h1, parts * passes) // parts == number)
            found.append((keys, g[mine], h1[mine], h2[mine]))
            if sum(len(x[1]) for x in found) > GATHERED:
                yield from dealt(found)
                found = []
        if found:
            yield from dealt(found)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[Keyed] = []
        for row in rows_of(batches):
            groups, halves = pk.unpacked_rows(row["_groups"]), np.frombuffer(row["_keys"], np.uint64).reshape(2, -1)
            found.append((groups.select(names), np.repeat(np.arange(groups.num_rows), groups.column("_size").to_numpy()), *halves))
        if found:
            keys, numbers = numbered_groups([x[0] for x in found])
            g = np.concatenate([n[x[1]] for n, x in zip(numbers, found, strict=True)])
            h1, h2 = (np.concatenate([x[i] for x in found]) for i in (2, 3))
            del found
            order, new = pk.sorted_keys(h1, h2, g)
            unique = np.bincount(g[order[new]], minlength=keys.num_rows)
            yield pa.RecordBatch.from_arrays([*keys.columns, pa.array(unique, pa.int64())], [*names, "_unique"])

    met = held.mapInArrow(asked, "_part int, _groups binary, _keys binary").repartitionById(parts, "_part")
    return met.mapInArrow(counted, T.StructType([*group, T.StructField("_unique", T.LongType())]))


def numbered_groups(batches: Sequence[pa.RecordBatch]) -> tuple[pa.RecordBatch, list[np.ndarray]]:
    """The distinct rows of some batches, and of each batch which of them its rows are."""
    seen: dict[tuple, int] = {}
    rows = pa.Table.from_batches(batches).combine_chunks()
    keys = list(zip(*(c.to_pylist() for c in rows.columns), strict=True))
    numbers = np.array([seen.setdefault(k, len(seen)) for k in keys], np.int64)
    first = np.unique(numbers, return_index=True)[1]
    edges = np.cumsum([b.num_rows for b in batches])[:-1]
    chunks = rows.take(pa.array(first, pa.int64())).combine_chunks().to_batches()
    return (chunks[0] if chunks else batches[0].slice(0, 0)), np.split(numbers, edges)
