"""Alignment, embedding, perplexity and outcome metrics, and the metric collection."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import alignment as al
from tablewright.functions import text as tx
from tablewright.operators import bigrams as bg
from tablewright.operators import overlap as ov
from tablewright.operators.blocks import block_table, shuffles_dropped, words_of
from tablewright.operators.sized import lookup, pinned, task_count
from tablewright.session import durable

GROUP = ov.GROUP
KEYS = ov.KEYS


def _words_for_rouge(c: Column, stem: bool) -> Column:
    tokens = tx.alnum_words(c)
    return al.stem_words(tokens) if stem else tokens


def rouge_l(
    df: DataFrame, keys: Sequence[str] = KEYS, prediction: str = "prediction", reference: str = "reference",
    stem: bool = False,
) -> DataFrame:
    """``rougeL`` and ``rougeLsum`` per example."""
    pred, ref = (_words_for_rouge(F.col(c), stem) for c in (prediction, reference))

    def sentences(c: str) -> Column:
        lines = F.filter(F.split(F.coalesce(F.col(c), F.lit("")), "\n"), lambda s: s != "")
        return F.transform(lines, tx.alnum_words)

    def lines_of(c: str) -> Column:
        return al.stem_lines(sentences(c)) if stem else sentences(c)

    return df.select(
        *keys,
        al.rouge_l_udf(ref, pred).alias("rougeL"),
        al.rouge_lsum_udf(lines_of(reference), lines_of(prediction)).alias("rougeLsum"),
    )


def meteor(
    df: DataFrame, keys: Sequence[str] = KEYS, prediction: str = "prediction", references: str | Column = "references",
    synonyms: dict[str, str] | None = None,
) -> DataFrame:
    refs = F.col(references) if isinstance(references, str) else references
    # one row is much work, and a table of few files few tasks
    return df.repartition(task_count(df), *keys).select(
        *keys,
        al.meteor_udf(synonyms=synonyms)(tx.words(prediction), F.transform(refs, tx.words)).alias("meteor"),
    )


def ter(
    df: DataFrame, by: Sequence[str] = GROUP, prediction: str = "prediction", reference: str = "reference",
    case_sensitive: bool = False,
) -> DataFrame:
    """Word edits over reference words, without block moves."""
    shape = (lambda c: F.col(c)) if case_sensitive else (lambda c: F.lower(F.col(c)))
    edits = al.word_edits_udf(tx.words(shape(prediction)), tx.words(shape(reference)))
    sums = (
        df.select(*by, prediction, reference)
        .repartition(task_count(df))
        .select(*by, edits.alias("_e"), tx.word_count(shape(reference)).alias("_n"))
        .groupBy(*by)
        .agg(F.sum("_e").alias("edits"), F.sum("_n").alias("ref_words"))
    )
    return sums.withColumn("ter", ov.ratio(F.col("edits"), F.col("ref_words")))


def pass_at_k(
    outcomes: DataFrame, k_values: Sequence[int], problem: Sequence[str], passed: str, by: Sequence[str] = ()
) -> DataFrame:
    """Unbiased pass@k per k: one minus the share of k-subsets without a pass."""
    per_problem = outcomes.groupBy(*by, *problem).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(passed)).alias("c")
    )
    long = per_problem.select("*", F.explode(F.array(*[F.lit(k) for k in k_values])).alias("k"))
    n, c, k = F.col("n"), F.col("c"), F.col("k")
    # prod_{i<k} (n-c-i) / (n-i): k terms, however many runs pass
    missed = F.aggregate(F.sequence(F.lit(0), k - 1), F.lit(1.0), lambda acc, i: acc * ((n - c - i) / (n - i)))
    estimate = F.when(c == 0, 0.0).when(n - c < k, 1.0).otherwise(1 - missed)
    return long.filter(n >= k).groupBy(*by, "k").agg(
        F.avg(estimate).alias("pass_at_k"), F.count(F.lit(1)).alias("problems")
    )


def perplexity(chunks: DataFrame, loss: str = "loss", size: str = "n_tokens", by: Sequence[str] = ()) -> DataFrame:
    """exp of the token-weighted mean loss; chunks under two tokens are skipped."""
    usable = F.col(size) >= 2
    sums = chunks.groupBy(*by).agg(
        F.sum(F.when(usable, F.col(loss) * F.col(size))).alias("total_loss"),
        F.coalesce(F.sum(F.when(usable, F.col(size))), F.lit(0)).alias("total_tokens"),
    )
    value = F.when(F.col("total_tokens") > 0, F.exp(F.col("total_loss") / F.col("total_tokens")))
    return sums.withColumn("perplexity", F.coalesce(value, F.lit(float("inf"))))


def token_chunks(n_tokens: Column, stride: int = 512, max_length: int | None = None) -> Column:
    """Sizes of the windows a text of so many tokens is scored in; ``max_length`` cuts it first."""
    n = n_tokens if max_length is None else F.least(n_tokens, F.lit(max_length))
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(stride))
    return F.transform(starts, lambda s: F.least(n - s, F.lit(stride)))


# --- count-based language model ----------------------------------------------


def ngram_lm_fit(df: DataFrame, column: str, tokens: DataFrame | None = None) -> DataFrame:
    """Bigram counts with the count of their first word: ``(prev, word, n, n_prev)``.

    A model is read several times, so it is stored. ``tokens``, here and below, are the texts as ``block_table``
    stores them; without them they are split into words once more.
    """
    with block_table(df, [], column, tokens) as held:
        return bg.counted(df, held)


def vocabulary_size(df: DataFrame, column: str, tokens: DataFrame | None = None) -> int:
    with block_table(df, [], column, tokens) as held, shuffles_dropped(df.sparkSession):
        return words_of(held).distinct().count()


def ngram_lm_score(
    df: DataFrame, column: str, model: DataFrame, vocabulary: int, row_id: str = "row_id", k: float = 1.0,
    tokens: DataFrame | None = None,
) -> DataFrame:
    """Perplexity of every text of two or more words under add-k bigrams.

    Pairs travel as 128-bit hashes, each once for a block of texts. A pair that the model lacks still needs
    the count of its first word, so first words are looked up by themselves.
    """
    with block_table(df, [row_id], column, tokens) as held:
        rows = bg.scored(df, held, model, vocabulary, row_id, k)
    return rows.select(row_id, F.exp(-F.col("_sum") / F.col("_n")).alias("perplexity"), F.col("_n").alias("n_bigrams"))


def perplexity_filter(df: DataFrame, scores: DataFrame, limit: float, row_id: str = "row_id") -> DataFrame:
    """Rows at or below the limit; rows too short for a score stay."""
    return df.join(pinned(scores.filter(F.col("perplexity") > limit).select(row_id)), row_id, "left_anti")


# --- embeddings --------------------------------------------------------------


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def similarity(a: str | Column, b: str | Column, metric: str = "cosine") -> Column:
    x, y = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    if metric == "dot":
        return dot(x, y)
    if metric == "cosine":
        norm = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
        return F.when(norm > 0, dot(x, y) / norm).otherwise(F.lit(0.0))
    gaps = F.zip_with(x, y, lambda p, q: p.cast("double") - q.cast("double"))
    if metric == "euclidean":
        return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g * g))
    if metric == "manhattan":
        return F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + F.abs(g))
    raise ValueError("metric must be cosine, dot, euclidean or manhattan")


def bertscore(df: DataFrame, predicted: str, reference: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Greedy matching of supplied token vectors; a row holds both lists."""
    return _bertscore(df.select(*keys, al.greedy_cosine_udf(F.col(predicted), F.col(reference)).alias("_s")), keys)


def token_idf(tokens: DataFrame, document: Sequence[str]) -> DataFrame:
    """(token, idf, n): ln((M + 1) / (d + 1)), with d of the M documents holding the token, n times in all."""
    total = tokens.select(*document).distinct().count()
    held = F.count_distinct(F.struct(*document))
    return tokens.groupBy("token").agg(
        F.log((F.lit(total) + 1) / (held + 1)).alias("idf"), F.count(F.lit(1)).alias("n")
    )


def idf_bertscore(tokens: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Greedy matching in which rare tokens count more.

    ``tokens`` has the keys, ``predicted`` (which side), ``position``, ``token`` and ``vector``. Document
    frequencies come from the reference sides; a token that they lack has the weight of none.
    """
    keys = list(keys)
    stored = durable(tokens.select(*keys, "predicted", "position", "token", "vector"))
    idf = token_idf(stored.filter("NOT predicted"), keys)
    unseen = math.log(stored.filter("NOT predicted").select(*keys).distinct().count() + 1)
    weighed = lookup(stored, idf.withColumnRenamed("n", "_n"), ["token"], weight="_n")
    one = F.struct("position", "vector", F.coalesce("idf", F.lit(unseen)).alias("weight"))
    # a side's tokens belong together by definition
    sides = weighed.groupBy(*keys).agg(*[F.array_sort(F.collect_list(F.when(F.col("predicted") == p, one))).alias(n) for p, n in ((True, "_p"), (False, "_r"))])
    return _bertscore(sides.select(*keys, al.weighted_cosine_udf("_p", "_r").alias("_s")), keys)


def _bertscore(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    p, r = F.col("_s.precision"), F.col("_s.recall")
    return scored.select(
        *keys,
        p.alias("bertscore_precision"),
        r.alias("bertscore_recall"),
        F.when(p + r != 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)).alias("bertscore_f1"),
    )


def score_summary(scores: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Mean, standard deviation (of the sample), bounds and count of each score per group, in long form."""
    values = F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns]))
    return scores.select(*by, values).groupBy(*by, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"), F.count("value").alias("n")
    )


# --- metric collection -------------------------------------------------------

CUSTOM_METRICS: dict[str, tuple[Callable[[DataFrame], DataFrame], bool]] = {}


def custom_metric(name: str, fn: Callable[[DataFrame], DataFrame], higher_is_better: bool = True) -> None:
    """Register ``fn``: predictions to ``(dataset, model, value)``."""
    CUSTOM_METRICS[name] = (fn, higher_is_better)


@dataclass(frozen=True)
class Fold:
    """An aggregate metric: ``start`` makes a state of numbers, ``add`` takes a batch's columns into it,
    ``merge`` joins two states, ``finish`` gives the value. States are lists of floats of one length."""

    columns: tuple[str, ...]
    start: Callable[[], list[float]]
    add: Callable[[list[float], dict[str, pd.Series]], list[float]]
    merge: Callable[[list[float], list[float]], list[float]]
    finish: Callable[[list[float]], float]


def folded(df: DataFrame, fold: Fold, by: Sequence[str] = GROUP) -> DataFrame:
    """The group columns and the value of an aggregate metric.

    Each task folds its rows batch by batch into one state for each group; only states are shuffled.
    """
    by = list(by)
    fields = [df.schema[c] for c in by]
    schema = T.StructType([*fields, T.StructField("_state", T.ArrayType(T.DoubleType()))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, list[float]] = {}
        types: list[pa.DataType] = []
        for batch in batches:
            types = [batch.schema.field(c).type for c in by]
            places: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in by), strict=True)):
                places.setdefault(key, []).append(i)
            for key, at in places.items():
                part = batch.take(pa.array(at))
                series = {c: part.column(c).to_pandas() for c in fold.columns}
                states[key] = fold.add(states[key] if key in states else fold.start(), series)
        if states:
            keys = [pa.array([k[i] for k in states], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array([list(map(float, s)) for s in states.values()], pa.list_(pa.float64()))], [*by, "_state"])

    @F.arrow_udf("double")
    def merged(states: pa.Array) -> float:
        out = fold.start()
        for s in states.to_pylist():
            out = fold.merge(out, s)
        return float(fold.finish(out))

    parts = df.select(*by, *[c for c in fold.columns if c not in by]).mapInArrow(partial, schema)
    return parts.groupBy(*by).agg(merged("_state").alias("value"))


def fold_metric(name: str, fold: Fold, higher_is_better: bool = True) -> None:
    """Register an aggregate metric over the predictions."""
    custom_metric(name, lambda df: folded(df, fold), higher_is_better)


def best_and_worst(values: DataFrame) -> DataFrame:
    """Of ``(dataset, model, metric, value)`` the best and the worst model for each dataset and metric.

    Smaller is better for metrics registered so and for ``LOWER_IS_BETTER``; equal values go to the first
    model by name. Null values take no part.
    """
    lower = [*LOWER_IS_BETTER, *(n for n, (_, up) in CUSTOM_METRICS.items() if not up)]
    signed = F.when(F.col("metric").isin(*lower), -F.col("value")).otherwise(F.col("value"))
    rows = values.filter("value IS NOT NULL").withColumn("_s", signed)
    return rows.groupBy("dataset", "metric").agg(
        F.min_by("model", F.struct(-F.col("_s"), F.col("model"))).alias("best_model"),
        F.min_by("value", F.struct(-F.col("_s"), F.col("model"))).alias("best_value"),
        F.min_by("model", F.struct(F.col("_s"), F.col("model"))).alias("worst_model"),
        F.min_by("value", F.struct(F.col("_s"), F.col("model"))).alias("worst_value"),
    )


LOWER_IS_BETTER = ("perplexity", "ter", "self_bleu")
#: metrics of texts alone, and those that need columns of their own
TEXT_METRICS = ("rouge", "bleu", "meteor", "distinct", "chrf", "exact_match", "f1", "ter", "self_bleu")
COLUMN_METRICS = {"bertscore": ("prediction_vectors", "reference_vectors"), "perplexity": ("loss", "n_tokens")}


def calculate_all(df: DataFrame, metrics: Sequence[str] = TEXT_METRICS, custom: Sequence[str] = ()) -> DataFrame:
    """All asked metrics in long form: ``(dataset, model, metric, value)``. Those of ``COLUMN_METRICS``
    read the token vectors or losses that ``df`` has besides the texts."""
    for name in metrics:
        if name not in TEXT_METRICS and name not in COLUMN_METRICS:
            raise ValueError(f"Unknown metric: {name}. Available: {sorted([*TEXT_METRICS, *COLUMN_METRICS])}")
        lacking = [c for c in COLUMN_METRICS.get(name, ()) if c not in df.columns]
        if lacking:
            raise ValueError(f"Metric {name} needs the columns {lacking}")
    if not metrics and not custom:
        raise ValueError("no metric is asked for")
    # every metric reads the predictions again, so they are stored once
    df = durable(df)
    parts: list[DataFrame] = []

    def keep(frame: DataFrame, metric: str | Column, value: str) -> None:
        label = F.lit(metric) if isinstance(metric, str) else metric
        parts.append(frame.select(*GROUP, label.alias("metric"), F.col(value).cast("double").alias("value")))

    if "rouge" in metrics:
        scores = ov.rouge_n(df)
        keep(ov.summarize(scores, ["rouge1", "rouge2"]), F.col("metric"), "value")
        keep(ov.summarize(rouge_l(df), ["rougeL", "rougeLsum"]), F.col("metric"), "value")
    if "bleu" in metrics:
        keep(ov.corpus_bleu(ov.bleu_stats(df)), "bleu", "bleu")
    if "meteor" in metrics:
        keep(ov.summarize(meteor(df), ["meteor"]), F.col("metric"), "value")
    if "distinct" in metrics:
        table = ov.distinct_n(df, "prediction")
        keep(table, F.concat(F.lit("distinct_"), F.col("n").cast("string")), "distinct")
    if "chrf" in metrics:
        keep(ov.chrf(df), "chrf", "chrf")
    if "exact_match" in metrics:
        keep(ov.exact_match(df), "exact_match", "exact_match")
    if "f1" in metrics:
        keep(ov.f1_token(df), "f1", "f1")
    if "ter" in metrics:
        keep(ter(df), "ter", "ter")
    if "self_bleu" in metrics:
        keep(ov.self_bleu(df, "prediction", "example_id"), "self_bleu", "self_bleu")
    if "bertscore" in metrics:
        names = [f"bertscore_{x}" for x in ("precision", "recall", "f1")]
        keep(ov.summarize(bertscore(df, *COLUMN_METRICS["bertscore"]), names), F.col("metric"), "value")
    if "perplexity" in metrics:
        keep(perplexity(df, by=GROUP), "perplexity", "perplexity")
    for name in custom:
        if name not in CUSTOM_METRICS:
            raise ValueError(f"Unknown metric: {name}. Available: {sorted(CUSTOM_METRICS)}")
        keep(CUSTOM_METRICS[name][0](df), name, "value")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
