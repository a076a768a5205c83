"""Pairs of neighbouring words: counted with their texts, and looked up by blocks of texts in a counted table."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import grams
from tablewright.functions import packed as pk
from tablewright.operators import blocks as bl
from tablewright.operators.sized import pinned
from tablewright.session import durable, fresh_folder

#: fixed: pairs that blocks and model send in one of so many passes take about as much disk as the texts
PASSES = 4
#: a word that is not the first one of so many pairs of a block is never dealt out by pair
HOT_LEAST = 1000
#: rows handed back at once
ROWS = 1 << 16


def _pairs(block: bl.Block) -> tuple[np.ndarray, np.ndarray]:
    """The places where pairs begin, and the text of each."""
    inner = np.ones(len(block.ids), bool)
    inner[np.cumsum(block.sizes) - 1] = False
    return np.flatnonzero(inner), np.repeat(np.arange(len(block.sizes)), block.sizes - 1)


# --- counting ----------------------------------------------------------------


def counted(df: DataFrame, held: DataFrame) -> DataFrame:
    """``(prev, word, n, n_prev)`` of the blocks ``held`` of ``df``, stored.

    Pairs are dealt out by their first word, whose pairs are counted in one task; those of a word
    that begins many pairs by both words, and its sums come from the stored counts.
    """
    parts = bl.parts_of(df, bl.tokens_of(held))

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in bl.rows_of(batches):
            block = bl.block_of(row)
            first = np.bincount(block.ids[_pairs(block)[0]], minlength=len(block.words))
            most = np.flatnonzero(first >= max(HOT_LEAST, len(block.ids) / (2 * parts)))
            yield pa.RecordBatch.from_arrays([block.words.take(pa.array(most))], ["word"])

    with bl.shuffles_dropped(df.sparkSession):
        hot = pa.array([r["word"] for r in held.mapInArrow(frequent, "word string").distinct().collect()], pa.string())

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in bl.rows_of(batches):
            block = bl.block_of(row)
            at, _ = _pairs(block)
            size = np.int64(len(block.words))
            codes, counts = np.unique(block.ids[at] * size + block.ids[at + 1], return_counts=True)
            prev, word = codes // size, codes % size
            each = grams.word_hashes(block.words)
            by_pair = np.flatnonzero(pc.is_in(block.words, hot).to_numpy(zero_copy_only=False)[prev])
            key = each[0][prev]
            key[by_pair] = grams.longer([x[prev[by_pair]] for x in each], [x[word[by_pair]] for x in each])[0]
            part = pk.part_of(key, parts)
            order = np.argsort(part, kind="stable")
            prev, word, counts, part = prev[order], word[order], counts[order], part[order]
            for value, low, high in pk.split_by(part):
                runs = pk.split_by(prev[low:high])
                firsts = block.words.take(pa.array([x for x, _, _ in runs], pa.int64()))
                row = [
                    pk.packed_words(firsts), pk.packed_numbers(np.array([b - a for _, a, b in runs])),
                    pk.packed_words(block.words.take(pa.array(word[low:high]))), pk.packed_numbers(counts[low:high]),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([value], pa.int32()), *(pa.array([x], pa.binary()) for x in row)], ["_part", "_prev", "_sizes", "_word", "_n"]
                )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for row in bl.rows_of(batches):
            sizes = pk.unpacked_numbers(row["_sizes"])
            prev = pk.unpacked_words(row["_prev"]).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            found.append(pa.table([prev, pk.unpacked_words(row["_word"]), pa.array(pk.unpacked_numbers(row["_n"]))], ["prev", "word", "n"]))
        if not found:
            return
        whole = pa.concat_tables(found).group_by(["prev", "word"]).aggregate([("n", "sum")]).combine_chunks()
        del found
        prev = whole["prev"].combine_chunks().dictionary_encode()
        number, n = prev.indices.to_numpy().astype(np.int64), whole["n_sum"].to_numpy()
        sums = np.zeros(len(prev.dictionary), np.int64)
        np.add.at(sums, number, n)
        part_only = pc.is_in(prev.dictionary, hot).to_numpy(zero_copy_only=False)
        order = np.argsort(number, kind="stable")
        for low in range(0, len(order), ROWS):
            at = order[low : low + ROWS]
            number_at = number[at]
            yield pa.RecordBatch.from_arrays(
                [
                    prev.dictionary.take(pa.array(number_at)), whole["word"].combine_chunks().take(pa.array(at)), pa.array(n[at]),
                    pa.array(sums[number_at], mask=part_only[number_at]),
                ],
                ["prev", "word", "n", "n_prev"],
            )

    met = held.mapInArrow(dealt, "_part int, _prev binary, _sizes binary, _word binary, _n binary").repartitionById(parts, "_part")
    counts = bl.stored(met.mapInArrow(summed, "prev string, word string, n long, n_prev long"), fresh_folder(df.sparkSession, "bigrams"))
    if not len(hot):
        return counts
    with bl.shuffles_dropped(df.sparkSession):
        sums = pinned(durable(counts.filter("n_prev IS NULL").groupBy("prev").agg(F.sum("n").alias("_sum"))))
    return counts.join(sums, "prev", "left").select("prev", "word", "n", F.coalesce("n_prev", "_sum").alias("n_prev"))


# --- looking up --------------------------------------------------------------


def _pass_of(words: pa.Array, passes: int) -> np.ndarray:
    """By the first word, as ``crc32`` of Spark has it."""
    return np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.int64, len(words)) % passes


def _heads(each: list[np.ndarray]) -> list[np.ndarray]:
    """Keys of first words alone: no word has a space."""
    return grams.longer(each, [x[[0] * len(each[0])] for x in grams.word_hashes(pa.array([" "]))])


class _Words:
    """The pairs of a block, and the hashes and passes of its words."""

    def __init__(self, block: bl.Block, passes: int):
        at, self.text = _pairs(block)
        self.prev, self.word = block.ids[at], block.ids[at + 1]
        self.each, self.turn = grams.word_hashes(block.words), _pass_of(block.words, passes)


class _Asked:
    """The keys a block looks up in a pass, ordered by their first halves: pairs, and first words alone."""

    def __init__(self, words: _Words, number: int):
        mine = np.flatnonzero(words.turn[words.prev] == number)
        own, follows, self.text = words.prev[mine], words.word[mine], words.text[mine]
        used = np.zeros(len(words.turn), bool)
        used[own] = True
        prev, self.prev = np.flatnonzero(used), (np.cumsum(used) - 1)[own]
        each = words.each
        pairs = grams.longer([x[own] for x in each], [x[follows] for x in each])
        h1, h2 = (np.concatenate(x) for x in zip(pairs, _heads([x[prev] for x in each]), strict=True))
        order, new = pk.sorted_keys(h1, h2)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        self.pair, self.head = place[: len(mine)], place[len(mine) :]
        self.h1, self.h2 = h1[order[new]], h2[order[new]]


_SENT = ["_part", "_block", "_keys", "_values"]


def _sent(h1: np.ndarray, h2: np.ndarray, block: int | None, values: np.ndarray | None, parts: int) -> Iterator[pa.RecordBatch]:
    """Keys, ordered by their first halves, in a row for each part."""
    for part, low, high in pk.split_by(pk.part_of(h1, parts)):
        keys = h1[low:high].tobytes() + h2[low:high].tobytes()
        row = [
            pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([keys], pa.binary()),
            pa.array([None if values is None else pk.packed_numbers(values[low:high])], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(row, _SENT)


def _answers(held: DataFrame, model: DataFrame, parts: int, passes: int, number: int) -> DataFrame:
    """``(_block, _pass, _part, _values)``: what the model has for the keys of a block, 0 for those it lacks."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in bl.rows_of(batches):
            block = bl.block_of(row)
            keys = _Asked(_Words(block, passes), number)
            yield from _sent(keys.h1, keys.h2, block.id, None, parts)

    def keyed(found: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(found).combine_chunks()
        prev, word = (rows[c].combine_chunks().dictionary_encode() for c in ("prev", "word"))
        p, w = prev.indices.to_numpy(), word.indices.to_numpy()
        each = grams.word_hashes(prev.dictionary)
        pairs = grams.longer([x[p] for x in each], [x[w] for x in grams.word_hashes(word.dictionary)])
        sums = np.zeros(len(prev.dictionary), np.int64)
        np.maximum.at(sums, p, rows["n_prev"].to_numpy())
        h1, h2 = (np.concatenate(x) for x in zip(pairs, _heads(each), strict=True))
        values = np.concatenate([rows["n"].to_numpy(), sums])
        order, new = pk.sorted_keys(h1, h2)
        yield from _sent(h1[order[new]], h2[order[new]], None, values[order[new]], parts)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.RecordBatch] = []
        for batch in batches:
            found.append(batch)
            if sum(b.num_rows for b in found) > bl.GATHERED // 4:
                yield from keyed(found)
                found = []
        if sum(b.num_rows for b in found):
            yield from keyed(found)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, wanted = [], []
        for row in bl.rows_of(batches):
            halves = np.frombuffer(row["_keys"], np.uint64).reshape(2, -1)
            if row["_values"] is None:
                wanted.append((row["_block"], row["_part"], halves))
            else:
                table.append((*halves, pk.unpacked_numbers(row["_values"])))
        h1, h2, values = (np.concatenate(x) for x in zip(*table, strict=True)) if table else (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        del table
        order, new = pk.sorted_keys(h1, h2)
        order = order[new]
        h1, h2, values = h1[order], h2[order], values[order]
        for block, part, (q1, q2) in wanted:
            at = pk.found_at(h1, h2, q1, q2)
            got = np.where(at >= 0, values[at], 0) if len(values) else np.zeros(len(at), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([number], pa.int32()), pa.array([part], pa.int32()), pa.array([pk.packed_numbers(got)], pa.binary())],
                ["_block", "_pass", "_part", "_values"],
            )

    fields = "_part int, _block long, _keys binary, _values binary"
    turn = F.crc32(F.col("prev").cast("binary")) % passes == number
    rows = held.mapInArrow(asked, fields).unionByName(model.select("prev", "word", "n", "n_prev").filter(turn).mapInArrow(known, fields))
    return rows.repartitionById(parts, "_part").mapInArrow(answered, "_block long, _pass int, _part int, _values binary")


def scored(df: DataFrame, held: DataFrame, model: DataFrame, vocabulary: int, row_id: str, k: float) -> DataFrame:
    """``(row_id, _sum, _n)``: the sum of the logarithms of each text's pairs and their number, stored. ``held``
    are the blocks of ``df`` with ``row_id``."""
    tokens = bl.tokens_of(held)
    parts = bl.parts_of(df, max(tokens, model.count()))
    key = df.schema[row_id]

    def points(block: bl.Block, answers: dict[int, list[tuple[int, bytes]]], passes: int) -> pa.RecordBatch:
        words, texts = _Words(block, passes), len(block.sizes)
        sums, count, met = np.zeros(texts), np.zeros(texts, np.int64), np.zeros(texts, bool)
        for number in range(passes):
            keys = _Asked(words, number)
            values = [pk.unpacked_numbers(v) for _, v in sorted(answers[number])]
            values = np.concatenate(values) if values else np.zeros(0, np.int64)
            if len(values) != len(keys.h1):
                raise ValueError(f"block {block.id} got {len(values)} of {len(keys.h1)} answers")
            p = (values[keys.pair] + k) / (values[keys.head][keys.prev] + k * vocabulary)
            # as in SQL, a probability of zero has no logarithm and is left out of the sum
            some = p > 0
            sums += np.bincount(keys.text[some], np.log(p[some]), texts)
            met[keys.text[some]] = True
            count += np.bincount(keys.text, minlength=texts)
        held = np.flatnonzero(count)
        columns = [block.keys.column(row_id).take(pa.array(held)), pa.array(sums[held], mask=~met[held]), pa.array(count[held])]
        return pa.RecordBatch.from_arrays(columns, [row_id, "_sum", "_n"])

    with bl.Folder(df.sparkSession, "scores") as folder:
        passes = min(PASSES, 1 + tokens // bl.GATHERED)

        def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts, answers = {}, defaultdict(lambda: defaultdict(list))
            for row in bl.rows_of(batches):
                if row["_ids"] is not None:
                    texts[row["_block"]] = row
                else:
                    answers[row["_block"]][row["_pass"]].append((row["_part"], row["_values"]))
            for number, row in texts.items():
                yield points(bl.block_of(row), answers.pop(number, defaultdict(list)), passes)

        each = [folder.stored(_answers(held, model, parts, passes, i)) for i in range(passes)]
        rows = held.unionByName(reduce(DataFrame.unionByName, each), allowMissingColumns=True).repartition(parts, "_block")
        sums = rows.mapInArrow(joined, T.StructType([key, T.StructField("_sum", T.DoubleType()), T.StructField("_n", T.LongType())]))
        with bl.shuffles_dropped(df.sparkSession):
            return durable(sums.groupBy(row_id).agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n")))
