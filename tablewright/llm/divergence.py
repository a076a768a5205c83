"""How far apart the sources of a language are in their words, all sources against all.

A group is a (lang, source) of the documents. A language keeps the terms that occur in at
least ``LEAST_DOCS`` of its documents. A group gives each kept term a smoothed share in
billionths; the distance of two groups is the sum of the absolute differences over all kept
terms. Besides the distances, each group lists the terms in which it exceeds its language most.

Gustavson row accumulation. The shares form a sparse matrix, groups by terms, beside one
number per group for the terms it lacks, its baseline. Row after row is multiplied with the
matrix's transpose: a group scatters its terms through the term-major index into a dense
accumulator with a place for each peer. So the pairs of postings are never rows of a frame.
The accumulator starts from the assumption that a peer has its baseline everywhere, which
sorted shares and their running sums give for all peers at once; every shared posting then
corrects it, and terms that both lack add the difference of the baselines. All of it is done in
64-bit whole numbers.

Spark deals the matrix out in cells of (language, block of groups, block of terms): some
``CELL_POSTINGS`` postings, more where there are thousands of sources, and accumulators of at most
``CELL_PLACES`` places each. Postings are
repeated for each block of groups, of which there is one below 2,000 sources. Cells return one
number per pair of groups, which are added up. A term's postings, one for each source, are
the longest list that exists.

Counting. Texts become (lang, source, term) counts inside the tasks, batch by batch, and are
added up before and after the shuffle, so a frequent term or a large source is many partial
counts but no large group.

Defined cases: null texts, languages and sources count as ''. Groups without terms and
languages without kept terms still have their pairs, the latter at distance 0. Repeated
rows each count as a document. Equal values are ranked by the item's UTF-8 bytes. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.tables import joined_small, stored
from tablewright.llm.textkit import LOWER, Runs, buffer_of, byte_class, slices

LEAST_DOCS = 30
UNIT = 1_000_000_000
ADDED = 5
TOP_TERMS = 50
CELL_POSTINGS = 50_000
CELL_PAIRS = 8
CELL_PLACES = 4_000_000
#: bytes of terms `[^\x00-\x40\x5B-\x60\x7B-\x7F]+`
LETTERS = byte_class([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
SLICE = 4 << 20


def _counts(piece: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, source, term), its occurrences and the documents it is in, of some documents."""
    words = Runs(*buffer_of(piece.column("text")), LETTERS)
    lengths = words.ends - words.starts
    body = LOWER[words.data[words.inside]]
    edges = np.concatenate(([0], np.cumsum(lengths)))
    terms = pa.StringArray.from_buffers(len(words), pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(body)).dictionary_encode()
    codes = terms.indices.to_numpy()
    lang, source = (piece.column(c).dictionary_encode() for c in ("lang", "source"))
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    size = max(1, len(terms.dictionary))
    in_doc, times = np.unique(words.row * size + codes, return_counts=True)  # by document
    key, place = np.unique(group[in_doc // size] * size + in_doc % size, return_inverse=True)
    n = np.bincount(place, times, len(key)).astype(np.int64)
    docs = np.bincount(place, minlength=len(key))
    at = key // size
    columns = [
        lang.dictionary.take(pa.array(at // len(source.dictionary))),
        source.dictionary.take(pa.array(at % len(source.dictionary))),
        terms.dictionary.take(pa.array(key % size)),
        pa.array(n),
        pa.array(docs, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n and docs, for every term of every group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                yield _counts(piece)

    partial = docs.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 5) / (total + 5 * terms)), exact; null for no terms."""
    wide = lambda c: c.cast("decimal(20,0)")
    parts = F.nullif((total + ADDED * terms).cast("bigint"), F.lit(0))
    floor = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * wide(count + ADDED), wide(parts))
    return (floor + 1).cast("bigint")


def row_sums(base: np.ndarray, ptr: np.ndarray, peer: np.ndarray, value: np.ndarray, first: int, last: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each group from ``first`` to before ``last``: what the cell's terms add to its distance
    to every group behind it and, for groups before it, what only this row knows.

    ptr, peer and value are the term-major index: the groups that have a term and their shares.
    The differences of baselines for terms that both lack are left out.
    """
    term = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    order = np.argsort(peer, kind="stable")  # group-major
    edge = np.searchsorted(peer[order], np.arange(first, last + 1))
    for g in range(first, last):
        mine = order[edge[g - first] : edge[g - first + 1]]
        own, here = value[mine], np.sort(value[mine])
        upto = np.concatenate(([0], np.cumsum(here)))
        k = np.searchsorted(here, base)
        # every term of the row against a peer that has its baseline
        total = base * k - upto[k] + (upto[-1] - upto[k]) - base * (len(here) - k)
        total -= len(here) * np.abs(base[g] - base)
        # scatter: each shared posting corrects both rows' assumption
        lengths = ptr[term[mine] + 1] - ptr[term[mine]]
        first_of = np.cumsum(lengths) - lengths
        at = np.arange(int(lengths.sum())) + np.repeat(ptr[term[mine]] - first_of, lengths)
        p, h, q = np.repeat(own, lengths), peer[at], value[at]
        fix = np.abs(p - q) - np.abs(p - base[h]) - np.abs(base[g] - q) + np.abs(base[g] - base[h])
        fix[h <= g] = 0  # once for each pair
        np.add.at(total, h, fix)
        yield g, total


SUMS = "lang string, low bigint, high bigint, value bigint"


def cell_sums(lang: object, block: int, size: int, part: int, terms: int, term: np.ndarray, place: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    """Sums of one cell by pair of groups; rows with term -1 are the baselines of all groups."""
    is_base = term < 0
    base = np.zeros(int(is_base.sum()), np.int64)
    base[place[is_base]] = value[is_base]
    order = np.argsort(term[~is_base], kind="stable")
    name, peer, share_ = term[~is_base][order], place[~is_base][order], value[~is_base][order]
    ptr = np.append(np.flatnonzero(np.diff(name, prepend=-1)), len(name))
    low, high, sums = [], [], []
    count = len(base)
    for g, total in row_sums(base, ptr, peer, share_, block * size, min(count, (block + 1) * size)):
        if part == 0:
            total = total + np.where(np.arange(count) > g, terms * np.abs(base - base[g]), 0)
        others = np.delete(np.arange(count), g)
        low.append(np.minimum(others, g))
        high.append(np.maximum(others, g))
        sums.append(total[others])
    columns = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (low, high, sums)]
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(columns[0]), pa.string()), *map(pa.array, columns)], ["lang", "low", "high", "value"])


def _cell(table: pa.Table) -> pa.Table:
    one = lambda c: table.column(c)[0].as_py()
    arrays = [table.column(c).to_numpy() for c in ("term", "place", "p")]
    return pa.Table.from_batches([cell_sums(one("lang"), one("block"), one("block_size"), one("part"), one("terms"), *arrays)])


def distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, low, high and value for every two groups of a language, low before high.

    shares has lang, term (a number), place and p; groups has lang, place, base, and of the language
    terms, postings and sources.
    """
    size = F.greatest(F.lit(1), F.floor(F.lit(CELL_PLACES) / F.col("sources"))).cast("bigint")
    langs = groups.select("lang", "terms", "postings", "sources").distinct().withColumn("block_size", size)
    # a cell returns a number for each pair of groups: with many groups it gets more postings
    each = F.col("sources") * F.col("sources") / CELL_PAIRS
    langs = langs.withColumn("blocks", F.ceil(F.col("sources") / F.col("block_size"))).withColumn(
        "parts", F.greatest(F.lit(1), F.ceil(F.col("postings") / F.greatest(F.lit(CELL_POSTINGS), each)))
    )
    langs = stored(langs.select("lang", "terms", "block_size", "blocks", "parts"), "languages")
    sized = lambda df: joined_small(df, langs, ["lang"])
    to_blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    columns = ["lang", "terms", "block_size", "part", "term", "place", "p"]
    spread = sized(shares).withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts"))).select(*columns, to_blocks)
    base = sized(groups.drop("terms")).withColumn("term", F.lit(-1).cast("bigint")).withColumn("p", F.col("base"))
    base = base.select("*", every).select(*columns, to_blocks)
    cells = spread.unionByName(base).groupBy("lang", "block", "part").applyInArrow(_cell, SUMS)
    return cells.groupBy("lang", "low", "high").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank: each group's distance to all other
    sources of its language, and its ``top_terms`` most exceeding terms."""
    named = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    docs = docs.select(named("lang"), named("source"), "text")
    posting = F.collect_list(F.struct("source", "n"))
    index = term_counts(docs).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), posting.alias("postings"))
    kept = index.filter(F.col("docs") >= least_docs).withColumn("number", F.monotonically_increasing_id())
    kept = stored(kept.select("lang", "term", "number", "postings"), "kept-terms")
    long = kept.select("lang", "term", "number", F.explode("postings").alias("x")).select("lang", "term", "number", "x.*")

    # one row for each group, however few terms it has
    totals = long.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = long.groupBy("lang").agg(F.count("*").alias("postings"), F.sum("n").alias("all"), F.count_distinct("number").alias("terms"))
    of_lang = Window.partitionBy("lang")
    groups = docs.groupBy("lang", "source").agg(F.count("*").alias("rows")).join(totals, ["lang", "source"], "left").join(whole, "lang", "left")
    zero = {"total": 0, "postings": 0, "all": 0, "terms": 0}
    groups = groups.fillna(zero).withColumns(
        {
            "place": (F.row_number().over(of_lang.orderBy("source")) - 1).cast("bigint"),
            "sources": F.count("*").over(of_lang),
            "base": F.coalesce(share(F.lit(0), F.col("total"), F.col("terms")), F.lit(0).cast("bigint")),
        }
    )
    groups = stored(groups.select("lang", "source", "total", "all", "terms", "postings", "place", "sources", "base"), "groups")

    counted = joined_small(long, groups.select("lang", "source", "total", "terms", "place"), ["lang", "source"])
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    shares = counted.select("lang", F.col("number").alias("term"), "place", p.alias("p"))
    sums = stored(distances(shares, groups), "distances")
    ways = sums.select("lang", F.col("low").alias("place"), F.col("high").alias("other"), "value").union(
        sums.select("lang", "high", "low", "value")
    )
    names = groups.select("lang", "place", "source")
    pairs = joined_small(ways, names, ["lang", "place"])
    pairs = joined_small(pairs, names.select("lang", F.col("place").alias("other"), F.col("source").alias("item")), ["lang", "other"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    langs = groups.select("lang", "all", "terms").distinct()
    of_term = kept.select("lang", "term", "number", F.aggregate("postings", F.lit(0).cast("bigint"), lambda s, x: s + x["n"]).alias("in_lang"), "postings")
    of_term = joined_small(of_term, stored(langs, "languages"), ["lang"])
    of_term = of_term.withColumn("q", share(F.col("in_lang"), F.col("all"), F.col("terms"))).select("lang", "term", "q", F.explode("postings").alias("x"))
    of_term = joined_small(of_term.select("lang", "term", "q", "x.*"), groups.select("lang", "source", "total", "terms"), ["lang", "source"])
    above = of_term.withColumn("value", p - F.col("q")).filter("value > 0")
    above = above.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return pairs.withColumn("rank", place).union(above.withColumn("rank", place).filter(F.col("rank") <= top_terms))
