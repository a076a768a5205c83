"""Structured Streaming: sources, stateful operators and run helpers."""

from __future__ import annotations

import heapq
import threading
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tablewright.operators import clean as cl
from tablewright.operators import templates as tp
from tablewright.operators import validate as va
from tablewright.operators.telemetry import Plateau
from tablewright.session import fresh_folder


REPORT_SECONDS = 120


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", files_per_trigger: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """A stream over the files of a folder; the schema is always given."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def take_n(stream: DataFrame, n: int) -> DataFrame:
    """The first n rows the stream delivers."""
    return stream.limit(n)


def stream_prepare(
    stream: DataFrame, template: str = "alpaca", rules: va.Rules = va.Rules(), ids: Sequence[str] = ("row_id",), **options
) -> DataFrame:
    """Validate, clean and format without state, by the functions used on tables."""
    return tp.format_table(cl.clean(va.validate(stream, rules)), template, ids=ids, **options)


def running_stats(stream: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Count, mean and bounds so far, for update or complete mode."""
    return stream.groupBy(*by).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def in_order(frames: Iterator[pd.DataFrame], step: str, value: str) -> Iterator[tuple]:
    """The (step, value) rows of several frames in step order, one at a time; of the frames only these
    two columns are held."""
    parts = []
    for frame in frames:
        ordered = frame[[step, value]].sort_values(step)
        parts.append(zip(ordered[step].to_numpy(), ordered[value].to_numpy()))
    return heapq.merge(*parts, key=lambda row: row[0])


def stream_plateau(
    stream: DataFrame, by: Sequence[str], step: str, value: str, patience: int = 3, threshold: float = 0.001
) -> DataFrame:
    """Plateau detection with one small state per run; emits a run when it should stop.

    Rows of a run must arrive in step order between batches; inside a batch they are
    sorted.
    """
    by = list(by)
    out_schema = T.StructType(
        [stream.schema[c] for c in by]
        + [T.StructField("best", T.DoubleType()), T.StructField("stop_evaluation", T.LongType())]
    )

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        best, best_at, seen, stopped = state.get if state.exists else (None, 0, 0, None)
        run, was_stopped = Plateau(best, best_at, stopped), stopped is not None
        for _, v in in_order(frames, step, value):
            if pd.notna(v):
                seen += 1
                run.see(seen, float(v), patience, threshold)
        run.settle(seen, patience)
        state.update((run.best, run.best_at, seen, run.stopped_at))
        rows = [] if was_stopped or run.stopped_at is None else [[*key, run.best, run.stopped_at]]
        yield pd.DataFrame(rows, columns=out_schema.names)

    return stream.groupBy(*by).applyInPandasWithState(
        advance,
        out_schema,
        T.StructType(
            [
                T.StructField("best", T.DoubleType()),
                T.StructField("best_at", T.LongType()),
                T.StructField("seen", T.LongType()),
                T.StructField("stopped_at", T.LongType()),
            ]
        ),
        "append",
        "NoTimeout",
    )


def run_to_parquet(stream: DataFrame, label: str, mode: str = "append", on_query: Callable[[object], None] | None = None) -> DataFrame:
    """Drain what is available into parquet files below the shared folder, and read them. ``on_query``
    is given the finished query."""
    spark = stream.sparkSession
    out, state = fresh_folder(spark, label), fresh_folder(spark, f"{label}-state")
    query = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if on_query is not None:
        on_query(query)
    return spark.read.schema(stream.schema).parquet(out)


def run_foreach(stream: DataFrame, label: str, sink: Callable[[DataFrame, int], None], mode: str = "append"):
    """Drain what is available through ``foreachBatch``; returns the finished query."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", fresh_folder(stream.sparkSession, f"{label}-state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_update_to_parquet(stream: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Drain an update-mode aggregate and read the last row of every key.

    Each batch writes its own folder, so that a repeated batch replaces itself.
    """
    spark = stream.sparkSession
    out = fresh_folder(spark, label)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/part={batch_id}")

    run_foreach(stream, label, write, "update")
    rows = spark.read.parquet(out).drop("part")
    values = [c for c in stream.columns if c not in keys]
    newest = F.max_by(F.struct(*values), "_batch").alias("_v")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


class LateRows(StreamingQueryListener):
    """Counts the rows that streams drop for being behind the watermark, batch by batch.

    A finished query keeps its last reports only; a listener gets them all. ::

        with LateRows(spark) as late:
            query = run_foreach(...)
        late.of(query)

    An aggregation reports rows as they reach its state, combined by task; a deduplication or a
    processor of its own reports every row.
    """

    def __init__(self, spark: SparkSession):
        super().__init__()
        self.spark = spark
        self.dropped: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def __enter__(self) -> LateRows:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        for ended in list(self.ended.values()):  # reports arrive after the queries end
            ended.wait(REPORT_SECONDS)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.batches[run] = self.batches.get(run, 0) + 1
        self.dropped[run] = self.dropped.get(run, 0) + sum(int(op.numRowsDroppedByWatermark or 0) for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def of(self, query) -> int:
        """Rows a finished query dropped."""
        ended = self.ended.get(str(query.runId))
        if ended is None or not ended.wait(REPORT_SECONDS):
            raise TimeoutError("the query's last report has not arrived")
        return self.dropped.get(str(query.runId), 0)
