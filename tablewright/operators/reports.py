"""Performance aggregates, model comparison, significance and example selection."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import text as tx
from tablewright.operators.replicates import poisson_counts, replicate_sums, signs
from tablewright.operators.scan import Running, scan
from tablewright.operators.selection import first_per_group
from tablewright.operators.sized import lookup, pinned
from tablewright.operators.stats import exact_percentiles
from tablewright.operators.validate import repetition_ratio
from tablewright.session import durable

LATENCY_POINTS = (50, 75, 90, 95, 99, 99.9)
METRIC_DIGITS, PERFORMANCE_DIGITS = 4, 2


def performance_summary(
    df: DataFrame, by: Sequence[str], order: Sequence[str], warmup: int = 3,
    latency: str = "latency_ms", tokens: str = "tokens_generated", memory: str = "memory_used_mb",
) -> DataFrame:
    """Latency, throughput and memory per group, its first ``warmup`` rows left out."""
    by, order = list(by), list(order)
    first = first_per_group(df.select(*by, *order), by, [F.col(c).asc() for c in order], warmup, "_rn")
    skipped = pinned(first.select(*by, *order))
    # null groups and order keys have warm-up rows as well
    same = reduce(lambda a, b: a & b, [F.col(f"rows.{c}").eqNullSafe(F.col(f"skipped.{c}")) for c in [*by, *order]])
    measured = df.alias("rows").join(skipped.alias("skipped"), same, "left_anti")
    mean_latency, mean_tokens = F.avg(latency), F.avg(tokens)
    return measured.groupBy(*by).agg(
        mean_latency.alias("avg_latency_ms"),
        F.when(mean_latency > 0, mean_tokens / (mean_latency / 1000)).otherwise(F.lit(0.0)).alias(
            "avg_throughput_tokens_per_sec"
        ),
        F.avg(memory).alias("avg_memory_mb"),
        F.max(memory).alias("peak_memory_mb"),
        F.count(F.lit(1)).alias("runs"),
    )


def latency_percentiles(
    df: DataFrame, by: Sequence[str], value: str = "latency_ms", points: Sequence[float] = LATENCY_POINTS
) -> DataFrame:
    return exact_percentiles(df, by, value, points)


def comparison_table(
    metrics: DataFrame, models: Sequence[str], digits: int = METRIC_DIGITS
) -> DataFrame:
    """Metric by model per dataset, as text, ``N/A`` where a model lacks the metric."""
    wide = metrics.groupBy("dataset", "metric").pivot("model", list(models)).agg(F.first("value"))
    # format_string turns null into the text "null", so nulls are tested first
    shown = [
        F.when(F.col(f"`{m}`").isNull(), F.lit("N/A"))
        .otherwise(F.format_string(f"%.{digits}f", F.col(f"`{m}`")))
        .alias(m)
        for m in models
    ]
    return wide.select("dataset", "metric", *shown)


def delta_table(metrics: DataFrame, base: str) -> DataFrame:
    """Absolute and relative change of every other model against ``base``."""
    reference = metrics.filter(F.col("model") == base).select(
        "dataset", "metric", F.col("value").alias("base_value")
    )
    others = metrics.filter(F.col("model") != base)
    change = F.col("value") - F.col("base_value")
    return others.join(reference, ["dataset", "metric"]).select(
        "dataset",
        "metric",
        "model",
        "base_value",
        "value",
        change.alias("absolute"),
        F.when(F.col("base_value") != 0, 100 * change / F.col("base_value")).alias("relative_pct"),
    )


def summary_rows(metrics: DataFrame, performance: DataFrame, by: Sequence[str] = ("model", "dataset")) -> DataFrame:
    """Metrics and unpivoted performance columns in one long table."""
    names = [c for c in performance.columns if c not in by]
    perf = performance.select(*by, *[F.col(c).cast("double").alias(f"perf_{c}") for c in names]).unpivot(
        list(by), [f"perf_{c}" for c in names], "metric", "value"
    )
    return metrics.select(*by, "metric", "value").unionByName(perf)


def aggregate_runs(runs: DataFrame, by: Sequence[str] = ("metric",), value: str = "value") -> DataFrame:
    return runs.groupBy(*by).agg(
        F.avg(value).alias("value"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.count(value).alias("runs"),
    )


def category_rollup(df: DataFrame, levels: Sequence[str], value: str, weight: str) -> DataFrame:
    """Weighted means per level with subtotals; ``level`` counts the columns rolled up."""
    return df.rollup(*levels).agg(
        (F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("weighted_mean"),
        F.sum(weight).alias("weight"),
        F.count(F.lit(1)).alias("n"),
        F.grouping_id().alias("level"),
    )


# --- resampling --------------------------------------------------------------


def poisson_bounds(limit: int = 12) -> list[float]:
    """Cumulative probabilities of a Poisson(1) count."""
    out, term, total = [], math.exp(-1), 0.0
    for i in range(limit):
        total += term
        out.append(total)
        term /= i + 1
    return out


def bootstrap_ci(
    df: DataFrame, value: str, row_id: str, by: Sequence[str] = (), samples: int = 1000,
    confidence: float = 0.95, seed: int = 42,
) -> DataFrame:
    """Percentile interval of the resampled mean.

    Every row enters a replicate a Poisson(1) number of times, drawn from a hash. A task folds its rows
    into one sum per group and replicate, and these are merged.
    """
    sums = replicate_sums(df, value, row_id, by, samples, seed, poisson_counts(poisson_bounds()))
    means = sums.withColumn("_mean", F.when(F.col("weight") > 0, F.col("total") / F.col("weight")))
    tail = (1 - confidence) / 2
    group = F.struct(*by, F.lit(0).alias("_all"))  # null groups are groups too
    bounds = means.groupBy(group.alias("_group")).agg(
        F.percentile("_mean", F.array(F.lit(tail), F.lit(1 - tail))).alias("_q"),
        F.count("_mean").alias("samples"),
    )
    centre = df.groupBy(group.alias("_group")).agg(F.avg(value).alias("mean"))
    columns = [F.col("_group")[c].alias(c) for c in by]
    return bounds.join(pinned(centre), "_group").select(*columns, "mean", F.col("_q")[0].alias("low"), F.col("_q")[1].alias("high"), "samples")


def permutation_test(
    pairs: DataFrame, difference: str, row_id: str, by: Sequence[str] = (), samples: int = 1000, seed: int = 42
) -> DataFrame:
    """Paired sign-flip test: how often a random sign gives a mean as far from zero."""
    by = list(by)
    rows = pairs.select(*by, row_id, difference).filter(F.col(difference).isNotNull())
    observed = rows.groupBy(*by).agg(F.avg(difference).alias("_observed"), F.count(F.lit(1)).alias("_rows"))
    group = F.struct(*by, F.lit(0).alias("_all"))  # null groups are groups too
    sums = replicate_sums(rows, difference, row_id, by, samples, seed, signs).select("*", group.alias("_group"))
    sums = sums.join(pinned(observed.select(group.alias("_group"), "_observed", "_rows")), "_group")
    sums = sums.withColumn("_t", F.col("total") / F.col("_rows"))
    # the observed mean is the same in every replicate of a group
    hit = F.abs("_t") >= F.abs("_observed") - 1e-12
    return sums.groupBy(*by).agg(
        F.first("_observed").alias("mean_difference"),
        ((F.count_if(hit) + 1) / (F.count(F.lit(1)) + 1)).alias("p_value"),
    )


@F.pandas_udf(T.DoubleType())
def two_sided_p(z: pd.Series) -> pd.Series:
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2)))


def wilcoxon_signed_rank(pairs: DataFrame, difference: str, by: Sequence[str] = ()) -> DataFrame:
    """Signed-rank test: zeros dropped, average ranks, normal approximation.

    Equal distances collapse first, so ranks come from a running count over distinct
    distances rather than from a window over all rows.
    """
    by = list(by)
    size = F.abs(difference)
    tied = (
        pairs.filter(F.col(difference) != 0)
        .groupBy(*by, size.alias("_d"))
        .agg(F.count(F.lit(1)).alias("_t"), F.count_if(F.col(difference) > 0).alias("_pos"))
    )
    ranked = scan(tied, by, ["_d"], Running("_upto", "sum", F.col("_t")))
    rank = F.col("_upto") - F.col("_t") + (F.col("_t") + 1) / 2
    sums = ranked.groupBy(*by).agg(
        F.sum("_t").alias("n"),
        F.sum(rank * F.col("_pos")).alias("w_plus"),
        F.sum(rank * (F.col("_t") - F.col("_pos"))).alias("w_minus"),
        F.sum(F.pow(F.col("_t").cast("double"), F.lit(3.0)) - F.col("_t")).alias("_ties"),
    )
    n = F.col("n").cast("double")
    centre = n * (n + 1) / 4
    spread = F.sqrt(n * (n + 1) * (2 * n + 1) / 24 - F.col("_ties") / 48)
    z = F.when(spread > 0, (F.least("w_plus", "w_minus") - centre) / spread).otherwise(F.lit(0.0))
    return sums.withColumn("z", z).withColumn("p_value", two_sided_p("z")).drop("_ties")


def bonferroni(tests: DataFrame, p: str = "p_value", alpha: float = 0.05) -> DataFrame:
    """p multiplied by the number of tests, at most 1."""
    n = tests.count()
    adjusted = F.least(F.col(p) * n, F.lit(1.0))
    return tests.withColumn("p_adjusted", adjusted).withColumn("significant", adjusted < alpha)


# --- examples ----------------------------------------------------------------


def qualitative_examples(
    scores: DataFrame, score: str, row_id: str, by: Sequence[str] = (), n: int = 10
) -> DataFrame:
    """The best, worst and most median examples of every group.

    Ids and scores are stored once; each task keeps n rows per group before the shuffle, and only
    the chosen rows are fetched whole.
    """
    by = list(by)
    wide = scores
    scores = durable(scores.select(*by, row_id, score))
    middle = exact_percentiles(scores.select(*by, score), by, score, [50]).select(
        *by, F.col("value").alias("_median")
    )
    if by:
        framed = lookup(scores, middle, by)
    else:
        framed = scores.withColumn("_median", F.lit(middle.first()["_median"]))
    value = F.col(score)
    orders = {
        "best": [value.desc()],
        "worst": [value.asc()],
        "median": [F.abs(value - F.col("_median")).asc()],
    }
    parts = [
        first_per_group(framed, by, [*order, F.col(row_id).asc()], n, "rank").select(row_id, "rank", F.lit(kind).alias("kind"))
        for kind, order in orders.items()
    ]
    chosen = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return wide.join(pinned(chosen), row_id).select(*wide.columns, "rank", "kind")


# Fixed value: openings of an answer that declines.
REFUSAL = r"(?i)\b(i cannot|i can't|i am unable|i'm unable|i'm sorry|as an ai)\b"


def error_class(prediction: str = "prediction", min_words: int = 3, max_repetition: float = 0.5) -> Column:
    """What is wrong with an answer, null when nothing is."""
    text = F.col(prediction)
    return (
        F.when(text.isNull() | tx.is_blank(text), "empty")
        .when(text.rlike(REFUSAL), "refusal")
        .when(tx.word_count(text) < min_words, "too_short")
        .when(repetition_ratio(text, 4) > max_repetition, "repeated")
    )


def failure_analysis(
    scores: DataFrame, score: str, row_id: str, prediction: str = "prediction", low: float = 0.1,
    max_failures: int = 50, **options,
) -> DataFrame:
    """The lowest-scoring failures: an error class, or a score below ``low``."""
    kind = F.coalesce(error_class(prediction, **options), F.when(F.col(score) < low, "low_score"))
    return (
        scores.withColumn("error_class", kind)
        .filter(F.col("error_class").isNotNull())
        .orderBy(F.col(score).asc(), F.col(row_id).asc())
        .limit(max_failures)
    )


def score_distribution(
    scores: DataFrame, score: str, by: Sequence[str] = (), low: float = 0.0, high: float = 1.0, bins: int = 10
) -> DataFrame:
    """Rows per bin; the highest value belongs to the last bin."""
    bin_of = F.least(F.width_bucket(F.col(score), F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins).cast("long"))
    return scores.groupBy(*by, bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def length_vs_score(scores: DataFrame, text: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    size = tx.word_count(text).cast("double")
    return scores.groupBy(*by).agg(
        F.corr(size, F.col(score)).alias("correlation"), F.count(F.lit(1)).alias("n")
    )


JUDGE_CATEGORIES = ("accuracy", "completeness", "clarity", "conciseness", "overall")


def judge_scores(
    replies: DataFrame, reply: str, by: Sequence[str] = (), categories: Sequence[str] = JUDGE_CATEGORIES
) -> DataFrame:
    """Mean score per category from recorded JSON replies, and the replies without one."""
    schema = ", ".join(f"{c} double" for c in categories)
    parsed = replies.select(*by, F.from_json(F.col(reply), schema, {"mode": "PERMISSIVE"}).alias("_r"))
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.col("_r")[c].alias("score")) for c in categories])
    return (
        parsed.select(*by, F.inline(pairs))
        .groupBy(*by, "category")
        .agg(
            F.avg("score").alias("mean_score"),
            F.count("score").alias("n_scored"),
            F.count_if(F.col("score").isNull()).alias("n_malformed"),
        )
    )


# --- report documents --------------------------------------------------------


def markdown_lines(table: DataFrame, models: Sequence[str], performance: DataFrame | None = None) -> DataFrame:
    """A comparison table as numbered markdown lines, a section per dataset.

    ``table`` and ``performance`` come from :func:`comparison_table`; both are as small
    as the number of datasets and metrics.
    """
    cells = F.concat_ws(" | ", F.col("metric"), *[F.col(f"`{m}`") for m in models])
    rows = table.select("dataset", F.lit(1).alias("part"), F.col("metric").alias("key"), F.concat(F.lit("| "), cells, F.lit(" |")).alias("line"))
    if performance is not None:
        perf = performance.select(
            "dataset", F.lit(3).alias("part"), F.col("metric").alias("key"), F.concat(F.lit("| "), cells, F.lit(" |")).alias("line")
        )
        rows = rows.unionByName(perf)
    head = "| Metric | " + " | ".join(models) + " |\n|" + "---|" * (len(models) + 1)
    heads = table.select("dataset").distinct().select(
        "dataset",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("part"), F.lit("").alias("key"), F.concat(F.lit("## Dataset: "), F.col("dataset"), F.lit("\n\n" + head)).alias("line")),
                *(
                    [F.struct(F.lit(2).alias("part"), F.lit("").alias("key"), F.lit("\n### Performance\n\n" + head).alias("line"))]
                    if performance is not None
                    else []
                ),
            )
        ),
    )
    return rows.unionByName(heads).orderBy("dataset", "part", "key")


def render_markdown(table: DataFrame, models: Sequence[str], performance: DataFrame | None = None) -> str:
    lines = markdown_lines(table, models, performance).select("line").toArrow().column(0).to_pylist()
    return "# Model Comparison Report\n\n" + "\n".join(lines)


def performance_rows(performance: DataFrame, by: Mapping[str, str] | Sequence[str] = ("model", "dataset")) -> DataFrame:
    """Performance columns as long metric rows for :func:`comparison_table`."""
    names = [c for c in performance.columns if c not in by]
    return performance.select(*by, *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        list(by), names, "metric", "value"
    )
