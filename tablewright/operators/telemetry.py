"""Summaries, windows and detectors over metric and request logs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.scan import Neighbour, RowNumber, Running, scan
from tablewright.session import durable


def metric_summary(
    df: DataFrame, by: Sequence[str] = ("run", "metric"), step: str = "step", value: str = "value",
    higher_is_better: bool = False,
) -> DataFrame:
    """Current, mean, spread, bounds, best value and the first step that reached it."""
    best = F.max(value) if higher_is_better else F.min(value)
    order = F.struct((-F.col(value) if higher_is_better else F.col(value)).alias("v"), F.col(step).alias("s"))
    return df.groupBy(*by).agg(
        F.max_by(value, step).alias("current"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        best.alias("best"),
        F.min_by(step, order).alias("best_step"),
        F.count(value).alias("n"),
    )


def latest(df: DataFrame, by: Sequence[str] = ("run", "metric"), step: str = "step", value: str = "value") -> DataFrame:
    return df.groupBy(*by).agg(F.max_by(value, step).alias("value"), F.max(step).alias("step"))


def running_best(
    df: DataFrame, by: Sequence[str] = ("run",), step: str = "step", value: str = "value", higher_is_better: bool = False
) -> DataFrame:
    """The best value before each step and whether the step improves on it."""
    how = "max" if higher_is_better else "min"
    out = scan(df, by, [step], Running("previous_best", how, F.col(value), inclusive=False))
    better = F.col(value) > F.col("previous_best") if higher_is_better else F.col(value) < F.col("previous_best")
    return out.withColumn("is_best", F.col("previous_best").isNull() | better)


@dataclass
class Plateau:
    """State of one run: best value, its evaluation, evaluations seen, the stop."""

    best: float | None = None
    best_at: int = 0
    stopped_at: int | None = None

    def see(self, at: int, value: float, patience: int, threshold: float) -> None:
        """Offer the value of evaluation ``at``; smaller is better."""
        if self.stopped_at is not None:
            return
        if self.best is None:
            self.best, self.best_at = value, at
            return
        self.settle(at - 1, patience)
        if self.stopped_at is None and value < self.best - threshold:
            self.best, self.best_at = value, at

    def settle(self, upto: int, patience: int) -> None:
        """Account for misses up to evaluation ``upto``."""
        if self.stopped_at is None and self.best is not None and upto - self.best_at >= patience:
            self.stopped_at = self.best_at + patience


def plateau_detect(
    df: DataFrame, by: Sequence[str] = ("run",), step: str = "step", value: str = "value", patience: int = 3,
    threshold: float = 0.001, higher_is_better: bool = False,
) -> DataFrame:
    """Per run: best value, its evaluation number, misses in a row and where to stop.

    The best value depends on its own history, but only a new strict minimum can move
    it. The scan finds those; the sequential part reads just them, in order, with a
    state of three numbers, and never holds a run in memory.
    """
    by = list(by)
    signed = -F.col(value) if higher_is_better else F.col(value)
    rows = df.filter(F.col(value).isNotNull()).select(*by, step, signed.alias("_v"))
    seen = scan(
        rows, by, [step], RowNumber("_at"), Running("_low", "min", F.col("_v"), inclusive=False)
    )
    lows = seen.filter(F.col("_low").isNull() | (F.col("_v") < F.col("_low"))).select(*by, "_at", "_v")
    schema = T.StructType(
        [seen.schema[c] for c in by]
        + [T.StructField("_best", T.DoubleType()), T.StructField("_best_at", T.LongType()), T.StructField("_stop", T.LongType())]
    )

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state = None, Plateau()

        def row() -> list:
            return [*key, state.best, state.best_at, state.stopped_at]

        for batch in batches:
            out = []
            for record in batch.itertuples(index=False, name=None):
                here, at, v = record[: len(by)], record[-2], record[-1]
                if here != key:
                    if key is not None:
                        out.append(row())
                    key, state = here, Plateau()
                state.see(at, v, patience, threshold)
            frame = pd.DataFrame(out, columns=schema.names)
            yield frame.astype({"_best_at": "int64", "_stop": "Int64"})
        if key is not None:
            yield pd.DataFrame([row()], columns=schema.names).astype({"_best_at": "int64", "_stop": "Int64"})

    order = [*by, "_at"]
    found = lows.repartition(*by).sortWithinPartitions(*order).mapInPandas(walk, schema)
    totals = seen.groupBy(*by).agg(F.max("_at").alias("_n"))
    late = F.when(F.col("_n") - F.col("_best_at") >= patience, F.col("_best_at") + patience)
    stop = F.coalesce("_stop", late)
    best = -F.col("_best") if higher_is_better else F.col("_best")
    return found.join(totals, by).select(
        *by,
        best.alias("best"),
        F.col("_best_at").alias("best_evaluation"),
        F.least(stop, F.col("_n")).alias("_end"),
        stop.alias("stop_evaluation"),
        F.col("_n").alias("evaluations"),
    ).withColumn("misses", F.col("_end") - F.col("best_evaluation")).drop("_end")


def throughput(
    df: DataFrame, by: Sequence[str] = ("run",), step: str = "step", ts: str = "ts", every: int = 10,
    batch_size: int = 4, accumulation: int = 4, sequence_length: int | None = None,
) -> DataFrame:
    """Steps, samples and tokens per second between every n-th step."""
    marks = df.filter(F.col(step) % every == 0).select(*by, step, ts)
    seen = scan(
        marks, by, [step], Neighbour("_ts", F.col(ts)), Neighbour("_step", F.col(step))
    ).filter(F.col("_ts").isNotNull())

    def micros(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp"))

    seconds = (micros(ts) - micros("_ts")) / 1_000_000
    steps = (F.col(step) - F.col("_step")) / seconds
    samples = steps * batch_size * accumulation
    return seen.filter(seconds > 0).select(
        *by,
        step,
        steps.alias("steps_per_sec"),
        samples.alias("samples_per_sec"),
        (samples * (sequence_length or 0)).alias("tokens_per_sec"),
    )


@dataclass(frozen=True)
class Rule:
    metric: str
    breaks: str  # a condition on ``value``
    severity: str
    message: str


# The documented alert thresholds.
ALERT_RULES = (
    Rule("loss", "isnan(value) OR abs(value) = double('Infinity')", "critical", "loss is not finite"),
    Rule("grad_norm", "value > 10", "warning", "gradient norm above 10"),
    Rule("learning_rate", "value = 0", "warning", "learning rate is zero"),
    Rule("gpu_memory_pct", "value > 95", "warning", "memory above 95 percent"),
    Rule("gpu_utilization_pct", "value < 50", "warning", "utilization below 50 percent"),
    Rule("eta_hours", "value > 48", "info", "more than 48 hours left"),
)


def alerts(df: DataFrame, rules: Sequence[Rule] = ALERT_RULES) -> DataFrame:
    """Rows that break a rule, with its severity and message."""
    hits = F.filter(
        F.array(
            *[
                F.when(
                    (F.col("metric") == r.metric) & F.expr(r.breaks),
                    F.struct(F.lit(r.severity).alias("severity"), F.lit(r.message).alias("message")),
                )
                for r in rules
            ]
        ),
        lambda x: x.isNotNull(),
    )
    return df.select("*", F.inline(hits))


def keep_last_n(df: DataFrame, n: int, by: Sequence[str] = ("run",), step: str = "step") -> DataFrame:
    """The newest n rows of each run; tasks drop the older ones before the shuffle."""
    newest = Window.partitionBy(*by).orderBy(F.col(step).desc())
    return df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")


# --- request logs ------------------------------------------------------------


def request_counters(
    df: DataFrame, size: str, slide: str | None = None, by: Sequence[str] = ("model", "status"), ts: str = "ts",
    tokens: str = "tokens_generated", watermark: str | None = None,
) -> DataFrame:
    """Requests and tokens per window; the same plan serves tables and streams."""
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (
        df.groupBy(window.alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("requests"), F.sum(tokens).alias("tokens"))
        .select(F.col("w.start").alias("window_start"), *by, "requests", "tokens")
    )


# Customary latency buckets, in seconds.
DURATION_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def duration_histogram(
    df: DataFrame, seconds: Column, by: Sequence[str] = ("model",), buckets: Sequence[float] = DURATION_BUCKETS
) -> DataFrame:
    """Cumulative counts per upper bound, the last one without limit."""
    counts = df.select(*by, seconds.alias("_s")).groupBy(*by).agg(
        *[F.count_if(F.col("_s") <= b).alias(f"_b{i}") for i, b in enumerate(buckets)],
        F.count("_s").alias("_all"),
    )
    pairs = F.array(
        *[F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"_b{i}").alias("n")) for i, b in enumerate(buckets)],
        F.struct(F.lit("+Inf").alias("le"), F.col("_all").alias("n")),
    )
    return counts.select(*by, F.inline(pairs))


def session_activity(
    df: DataFrame, gap_seconds: int, by: Sequence[str] = ("user_id",), ts: str = "ts", tie: str = "event_id"
) -> DataFrame:
    """Sessions separated by more than a gap: start, last use and requests.

    Two scans (gap to the previous row, running number of gaps) instead of a session
    window, so that one busy user is not one task.
    """
    by = list(by)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    gaps = durable(scan(df.select(*by, ts, tie), by, [ts, tie], Neighbour("_before", at)))
    opens = (F.col("_before").isNull() | (at - F.col("_before") > gap_seconds * 1_000_000)).cast("long")
    numbered = scan(gaps, by, [ts, tie], Running("session", "sum", opens))
    return numbered.groupBy(*by, "session").agg(
        F.min(ts).alias("started"), F.max(ts).alias("last_used"), F.count(F.lit(1)).alias("requests")
    )
