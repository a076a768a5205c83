"""Metrics that count shared n-grams of a prediction and its references.

The texts are partitioned once by the example key and counted there, batch by batch: n-grams
themselves are not shuffled. Where n-grams of a whole group are counted, hashes travel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import grams
from tablewright.functions import text as tx
from tablewright.functions.batches import groups_of, pieces
from tablewright.operators import blocks as bl
from tablewright.operators.sized import lookup, task_count
from tablewright.session import durable

KEYS = ("dataset", "model", "example_id")
GROUP = ("dataset", "model")


def _references(references: str | Column) -> Column:
    return F.col(references) if isinstance(references, str) else references


def example_texts(df: DataFrame, keys: Sequence[str], sides: Column) -> DataFrame:
    """``(keys, _side, _text)``: the texts of each example, with the place of each among ``sides``."""
    long = df.select(*keys, F.posexplode(sides).alias("_side", "_text"))
    listed = long.repartition(task_count(df), *keys).groupBy(*keys).agg(F.collect_list(F.struct("_side", "_text")).alias("_texts"))
    return listed.select(*keys, F.col("_texts._side").alias("_side"), F.col("_texts._text").alias("_text"))


def _unpacked(batch: pa.RecordBatch, names: Sequence[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch by the tokens in its columns ``names``, with the example of each text."""
    cost = np.zeros(batch.num_rows)
    for name in names:
        owner = np.repeat(np.arange(batch.num_rows), grams.sizes_of(batch.column(name)))
        cost += np.bincount(owner, grams.sizes_of(batch.column(name).flatten()), batch.num_rows)
    for part in pieces(batch, cost.astype(np.int64)):
        yield part, np.repeat(np.arange(part.num_rows), grams.sizes_of(part.column(names[0])))


def order_stats(
    df: DataFrame,
    tokens: Sequence[tuple[Callable[[Column], Column], Sequence[int]]],
    prediction: str = "prediction",
    references: str | Column = "references",
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """One row per example with ``match_n``, ``pred_n`` and ``ref_n`` for every order.

    Each of ``tokens`` turns an array of texts into one of token lists, or of texts that stand for their
    characters, whose n-grams of the given orders are counted; later ones are numbered on from the
    earlier ones. An example is counted in one task, from its whole texts. Of several references the
    highest count of an n-gram holds.
    """
    names = [f"_tokens{i}" for i in range(len(tokens))]
    texts = example_texts(df, keys, F.concat(F.array(F.col(prediction)), _references(references)))
    texts = texts.select(*keys, "_side", *[f(F.col("_text")).alias(n) for (f, _), n in zip(tokens, names)])
    shifts = [sum(max(o) for _, o in tokens[:i]) for i in range(len(tokens))]
    counts = [f"{what}_{n + shift}" for (_, orders), shift in zip(tokens, shifts) for n in orders for what in ("match", "pred", "ref")]
    asked = [list(orders) for _, orders in tokens]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, example in _unpacked(batch, names):
                side = part.column("_side").flatten().to_numpy()
                found: list[np.ndarray] = []
                for name, orders in zip(names, asked):
                    held = grams.matches(part.column(name).flatten(), example, side, part.num_rows, orders)
                    found += [x for n in orders for x in held[n]]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), *map(pa.array, found)], [*keys, *counts])

    schema = T.StructType([*(texts.schema[k] for k in keys), *(T.StructField(c, T.LongType()) for c in counts)])
    return texts.mapInArrow(counted, schema)


def each_text(tokens: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """``tokens`` of every text of an array."""
    return lambda texts: F.transform(texts, tokens)


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def f_measure(p: Column, r: Column, beta: float = 1.0) -> Column:
    w = beta * beta
    return F.when(p + r > 0, (1 + w) * p * r / (w * p + r)).otherwise(F.lit(0.0))


# --- ROUGE-N -----------------------------------------------------------------


def rouge_n(
    df: DataFrame,
    orders: Sequence[int] = (1, 2),
    prediction: str = "prediction",
    reference: str = "reference",
    keys: Sequence[str] = KEYS,
    stem: bool = False,
) -> DataFrame:
    """F1 of clipped n-gram overlap per example, a column ``rougeN`` per order."""

    def tokens(texts: Column) -> Column:
        found = F.transform(texts, tx.alnum_words)
        if stem:
            from tablewright.functions.alignment import stem_lines

            found = stem_lines(found)
        return found

    stats = order_stats(df, [(tokens, orders)], prediction, F.array(F.col(reference)), keys)
    scores = [
        f_measure(
            ratio(F.col(f"match_{n}"), F.col(f"pred_{n}")), ratio(F.col(f"match_{n}"), F.col(f"ref_{n}"))
        ).alias(f"rouge{n}")
        for n in orders
    ]
    return stats.select(*keys, *scores)


def summarize(scores: DataFrame, metrics: Sequence[str], by: Sequence[str] = GROUP) -> DataFrame:
    """Scores per example to ``(by, metric, value, std, min, max, n)``."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("score")) for m in metrics])
    return (
        scores.select(*by, F.inline(pairs))
        .groupBy(*by, "metric")
        .agg(
            F.avg("score").alias("value"),
            F.stddev_pop("score").alias("std"),
            F.min("score").alias("min"),
            F.max("score").alias("max"),
            F.count("score").alias("n"),
        )
    )


# --- BLEU --------------------------------------------------------------------

SMOOTHINGS = ("exp", "floor", "add-k", "none")
EPSILON = 0.1  # fixed value: what "exp" puts in place of a zero count


def bleu_stats(
    df: DataFrame,
    max_order: int = 4,
    prediction: str = "prediction",
    references: str | Column = "references",
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Per example: clipped matches and totals per order, own and closest length."""
    hyp = tx.word_count(prediction)
    closest = F.array_min(
        F.transform(
            _references(references),
            lambda r: F.struct(F.abs(tx.word_count(r) - hyp).alias("d"), tx.word_count(r).alias("len")),
        )
    )["len"]
    sized = df.select(
        *keys,
        F.col(prediction).alias("_pred"),
        _references(references).alias("_refs"),
        hyp.alias("hyp_len"),
        F.coalesce(closest, F.lit(0)).alias("ref_len"),
    )
    wide = [*keys, "hyp_len", "ref_len"]
    stats = order_stats(sized, [(each_text(tx.words), range(1, max_order + 1))], "_pred", "_refs", wide)
    # an order without n-grams still counts one in the denominator
    return stats.select(
        *wide,
        *[F.col(f"match_{n}") for n in range(1, max_order + 1)],
        *[F.greatest(F.col(f"pred_{n}"), F.lit(1)).alias(f"total_{n}") for n in range(1, max_order + 1)],
    )


def bleu_score(max_order: int = 4, smoothing: str = "exp") -> Column:
    """BLEU from ``match_n, total_n, hyp_len, ref_len``, of a sentence or summed up."""
    if smoothing not in SMOOTHINGS:
        raise ValueError(f"smoothing must be one of {SMOOTHINGS}")
    logs, zeros = [], F.lit(0)
    for n in range(1, max_order + 1):
        match, total = F.col(f"match_{n}"), F.col(f"total_{n}")
        p = match / total
        if smoothing == "exp":
            p = F.when(match == 0, EPSILON / total).otherwise(p)
        elif smoothing == "floor" and n > 1:
            p = (match + 1) / (total + 1)
        elif smoothing == "add-k":
            zeros = zeros + F.when(match == 0, 1).otherwise(0)
            p = F.when(match == 0, 1 / (F.pow(F.lit(2.0), zeros) * total)).otherwise(p)
        logs.append(F.log(p) / max_order)
    hyp, ref = F.col("hyp_len"), F.col("ref_len")
    penalty = (
        F.when(hyp > ref, F.lit(1.0)).when(hyp == 0, F.lit(0.0)).otherwise(F.exp(1 - ref / hyp))
    )
    score = penalty * F.exp(reduce(lambda a, b: a + b, logs))
    empty = F.col("match_1") == 0
    if smoothing == "none":
        empty = reduce(lambda a, b: a | b, [F.col(f"match_{n}") == 0 for n in range(1, max_order + 1)])
    return F.when(empty, F.lit(0.0)).otherwise(score)


def sentence_bleu(stats: DataFrame, max_order: int = 4, smoothing: str = "exp") -> DataFrame:
    return stats.withColumn("sentence_bleu", bleu_score(max_order, smoothing))


def corpus_bleu(
    stats: DataFrame, by: Sequence[str] = GROUP, max_order: int = 4, smoothing: str = "exp"
) -> DataFrame:
    """BLEU over summed counts, with mean and deviation of the sentence scores."""
    summed = [c for n in range(1, max_order + 1) for c in (f"match_{n}", f"total_{n}")] + ["hyp_len", "ref_len"]
    scored = sentence_bleu(stats, max_order, smoothing)
    totals = scored.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in summed],
        F.avg("sentence_bleu").alias("sentence_bleu_mean"),
        F.stddev_pop("sentence_bleu").alias("sentence_bleu_std"),
        F.count(F.lit(1)).alias("n"),
    )
    return totals.select(
        *by, bleu_score(max_order, smoothing).alias("bleu"), "sentence_bleu_mean", "sentence_bleu_std", "n"
    )


# --- diversity ---------------------------------------------------------------


def hashed_counts(texts: DataFrame, by: Sequence[str], orders: Sequence[int]) -> DataFrame:
    """``(by, n, _h1, _h2, c)``: the n-grams of the token lists in ``_tokens``, counted for each group of a
    slice of a batch. 128 bits stand for an n-gram in a shuffle."""
    by, orders = list(by), list(orders)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, row in _unpacked(batch, ["_tokens"]):
                group, first = groups_of(part, by)
                for n, rows, hashes in grams.hashed(part.column("_tokens").flatten(), orders):
                    (whose, h1, h2), c = grams.tallied([group[row[rows]], *(h.view(np.int64) for h in hashes)])
                    at = first.take(pa.array(whose))
                    fixed = [pa.array(np.full(len(c), n, np.int32)), pa.array(h1), pa.array(h2), pa.array(c)]
                    yield pa.RecordBatch.from_arrays([*(part.column(k).take(at) for k in by), *fixed], [*by, "n", "_h1", "_h2", "c"])

    fixed = [T.StructField("n", T.IntegerType()), *(T.StructField(x, T.LongType()) for x in ("_h1", "_h2", "c"))]
    return texts.mapInArrow(counted, T.StructType([*(texts.schema[k] for k in by), *fixed]))


def distinct_n(
    df: DataFrame, column: str, by: Sequence[str] = GROUP, orders: Sequence[int] = (1, 2, 3, 4),
    normalize: bool = True, approximate: bool = False,
) -> DataFrame:
    """Unique over total n-grams of each group, or the unique count."""
    by = list(by)
    if approximate:
        texts = df.select(*by, column).repartition(task_count(df))
        long = texts.select(*by, F.inline(tx.ngrams_up_to(tx.words(column), max(orders)))).filter(F.col("n").isin(*orders))
        table = long.groupBy(*by, "n").agg(
            F.approx_count_distinct("gram", 0.01).alias("unique_ngrams"), F.count(F.lit(1)).alias("total_ngrams")
        )
    else:
        table = _counted_ngrams(df, column, by, list(orders))
    value = F.col("unique_ngrams") / F.col("total_ngrams") if normalize else F.col("unique_ngrams").cast("double")
    return table.withColumn("distinct", value)


#: fixed: over so many passes block-wise distinct n-grams of four orders take about as much disk as the texts
PASSES = 6


def _counted_ngrams(df: DataFrame, column: str, by: list[str], orders: list[int]) -> DataFrame:
    """``(by, n, unique_ngrams, total_ngrams)`` for each group and order that has n-grams."""
    group = T.StructType([*(df.schema[k] for k in by), T.StructField("n", T.IntegerType())])
    names = group.fieldNames()

    def of_orders(block: bl.Block) -> tuple[pa.RecordBatch, np.ndarray]:
        """Every group of a block with every order, and the group of each text."""
        text, first = groups_of(block.keys, by)
        columns = [block.keys.column(k).take(first) for k in by]
        keys = [pa.concat_arrays([c] * len(orders)) for c in columns]
        return pa.RecordBatch.from_arrays([*keys, pa.array(np.repeat(orders, len(first)), pa.int32())], names), text

    def keys_of(block: bl.Block) -> bl.Keyed:
        keys, text = of_orders(block)
        each = keys.num_rows // max(len(orders), 1)
        found = [(text[rows] + each * orders.index(n), *h) for n, rows, h in grams.hashed_ids(block.words, block.ids, block.sizes, orders)]
        return keys, *(np.concatenate(x) for x in zip(*found, strict=True))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in bl.rows_of(batches):
            block = bl.block_of(row)
            keys, text = of_orders(block)
            each = keys.num_rows // max(len(orders), 1)
            n = np.concatenate([np.bincount(text, np.maximum(block.sizes - (k - 1), 0), each) for k in orders])
            yield pa.RecordBatch.from_arrays([*keys.columns, pa.array(n.astype(np.int64))], [*names, "_total"])

    with bl.Folder(df.sparkSession, "distinct") as folder:
        held = folder.stored(bl.blocks(df, by, column))
        tokens = bl.tokens_of(held)
        passes, tasks = min(PASSES, 1 + tokens * len(orders) // bl.GATHERED), bl.parts_of(df, tokens)
        added = held.mapInArrow(totals, T.StructType([*group, T.StructField("_total", T.LongType())]))
        parts = [folder.stored(bl.distinct_keys(held, keys_of, group, tasks, passes, i)) for i in range(passes)]
        rows = reduce(DataFrame.unionByName, (p.withColumn("_total", F.lit(0).cast("long")) for p in parts), added.withColumn("_unique", F.lit(0).cast("long")))
        table = rows.groupBy(*by, "n").agg(F.sum("_unique").alias("unique_ngrams"), F.sum("_total").alias("total_ngrams"))
        return durable(table.filter("total_ngrams > 0"))


def self_bleu(
    df: DataFrame, column: str, row_id: str, by: Sequence[str] = GROUP, max_order: int = 4, smoothing: str = "exp"
) -> DataFrame:
    """Mean BLEU of each text against all other texts of its group, without pairing them.

    A text's n-gram is clipped only where this text alone holds the group's highest
    count: it then loses the distance to the second highest. So per n-gram one holder
    and two counts suffice. The closest length among the others is the same length, if
    it occurs twice, or a neighbour in the list of distinct lengths.
    """
    by = list(by)
    sized = df.select(*by, F.col(row_id).alias("_id"), F.col(column).alias("_text"))
    texts = example_texts(sized, [*by, "_id"], F.array("_text")).select(*by, "_id", each_text(tx.words)(F.col("_text")).alias("_tokens"))
    counts = hashed_counts(texts, [*by, "_id"], range(1, max_order + 1))
    # per n-gram one row for each distinct count, so the lists below stay short
    levels = counts.groupBy(*by, "n", "_h1", "_h2", "c").agg(
        F.count(F.lit(1)).alias("m"), F.min("_id").alias("_id")
    )
    top = levels.groupBy(*by, "n", "_h1", "_h2").agg(
        F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("c", "m", "_id")))), 1, 2).alias("_top")
    )
    losses = (
        top.filter(F.col("_top")[0]["m"] == 1)
        .select(
            *by,
            F.col("_top")[0]["_id"].alias("_id"),
            "n",
            (F.col("_top")[0]["c"] - F.coalesce(F.get("_top", F.lit(1))["c"], F.lit(0))).alias("_loss"),
        )
        .groupBy(*by, "_id")
        .agg(*[F.sum(F.when(F.col("n") == n, F.col("_loss")).otherwise(0)).alias(f"_loss_{n}") for n in range(1, max_order + 1)])
    )
    own = sized.withColumn("hyp_len", tx.word_count("_text")).drop("_text")
    ordered = Window.partitionBy(*by).orderBy("hyp_len")  # distinct lengths only
    lengths = (
        own.groupBy(*by, "hyp_len")
        .agg(F.count(F.lit(1)).alias("_m"))
        .withColumn("_lo", F.lag("hyp_len").over(ordered))
        .withColumn("_hi", F.lead("hyp_len").over(ordered))
        .withColumn(
            "ref_len",
            F.when(F.col("_m") > 1, F.col("hyp_len"))
            .when(F.col("_lo").isNull(), F.col("_hi"))
            .when(F.col("_hi").isNull(), F.col("_lo"))
            .when(F.col("hyp_len") - F.col("_lo") <= F.col("_hi") - F.col("hyp_len"), F.col("_lo"))
            .otherwise(F.col("_hi")),
        )
        .select(*by, "hyp_len", "ref_len", "_m")
    )
    stats = lookup(own.join(losses, [*by, "_id"], "left"), lengths, [*by, "hyp_len"], weight="_m")
    for n in range(1, max_order + 1):
        total = F.greatest(F.col("hyp_len") - (n - 1), F.lit(0))
        stats = stats.withColumn(f"match_{n}", total - F.coalesce(f"_loss_{n}", F.lit(0))).withColumn(
            f"total_{n}", F.greatest(total, F.lit(1))
        )
    return (
        stats.withColumn("_bleu", F.when(F.col("ref_len").isNotNull(), bleu_score(max_order, smoothing)))
        .groupBy(*by)
        .agg(F.avg("_bleu").alias("self_bleu"), F.count(F.lit(1)).alias("n"))
    )


# --- character and token F-scores --------------------------------------------


def chrf(
    df: DataFrame, by: Sequence[str] = GROUP, char_order: int = 6, word_order: int = 2, beta: float = 2.0,
    lowercase: bool = False, prediction: str = "prediction", reference: str = "reference", keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Corpus chrF, 0 to 100: mean precision and recall over the orders both sides have.

    Characters are joined without a separator; word orders follow the character ones.
    """

    shape = F.lower if lowercase else (lambda t: t)
    tokens = [(each_text(lambda t: tx.without_space(shape(t))), range(1, char_order + 1))]
    if word_order:
        tokens.append((each_text(lambda t: tx.metric_words(shape(t))), range(1, word_order + 1)))
    stats = order_stats(df, tokens, prediction, F.array(F.col(reference)), keys)
    each = [F.struct(F.lit(n).alias("n"), *[F.col(f"{x}_{n}").alias(x) for x in ("match", "pred", "ref")]) for n in range(1, char_order + word_order + 1)]
    orders = (
        stats.select(*by, F.inline(F.array(*each)))
        .groupBy(*by, "n")
        .agg(F.sum("match").alias("_m"), F.sum("pred").alias("_p"), F.sum("ref").alias("_r"))
        .filter("_p > 0 AND _r > 0")
    )
    means = orders.groupBy(*by).agg(
        F.avg(F.col("_m") / F.col("_p")).alias("chr_p"), F.avg(F.col("_m") / F.col("_r")).alias("chr_r")
    )
    return means.select(*by, (100 * f_measure(F.col("chr_p"), F.col("chr_r"), beta)).alias("chrf"))


def f1_token(
    df: DataFrame, by: Sequence[str] = GROUP, average: str = "micro", prediction: str = "prediction",
    reference: str = "reference", keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Token overlap: precision, recall and F1 from summed counts, or mean F1 (macro)."""

    tokens = each_text(lambda t: tx.words(tx.normalize_answer(t)))
    stats = order_stats(df, [(tokens, [1])], prediction, F.array(F.col(reference)), keys)
    p, r = ratio(F.col("match_1"), F.col("pred_1")), ratio(F.col("match_1"), F.col("ref_1"))
    if average == "macro":
        per_row = stats.select(*by, p.alias("p"), r.alias("r"), f_measure(p, r).alias("f"))
        return per_row.groupBy(*by).agg(
            F.avg("p").alias("precision"), F.avg("r").alias("recall"), F.avg("f").alias("f1")
        )
    sums = stats.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("match_1", "pred_1", "ref_1")])
    return sums.select(*by, p.alias("precision"), r.alias("recall"), f_measure(p, r).alias("f1"))


def exact_match(
    df: DataFrame, by: Sequence[str] = GROUP, normalize: bool = True, ignore_case: bool = True,
    ignore_punctuation: bool = True, ignore_numbers: bool = False, prediction: str = "prediction",
    reference: str = "reference",
) -> DataFrame:
    def shape(c: str) -> Column:
        return tx.normalize_answer(c, ignore_case, ignore_punctuation, ignore_numbers) if normalize else F.col(c)

    same = shape(prediction) == shape(reference)
    return df.groupBy(*by).agg(
        F.avg(same.cast("double")).alias("exact_match"), F.count(F.lit(1)).alias("n")
    )
