"""Plateau detection with a value state and an ordered buffer per run.

Rows of a run are taken one at a time. A row waits in the buffer until ``reorder`` rows with later
steps have come, so rows may arrive out of order by so many, within a batch and, with ``hold``,
between batches. Neither a batch nor a run is ever held: memory is ``reorder`` rows of one run, and so
is the state, however long the run is.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tablewright.operators.telemetry import Plateau

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = T.StructType().add("best", T.DoubleType()).add("best_at", T.LongType()).add("seen", T.LongType()).add("last", T.LongType()).add("late", T.LongType())
WAITING = T.StructType().add("step", T.LongType()).add("value", T.DoubleType())


@contextmanager
def rocksdb_state(spark: SparkSession):
    """The state store that processors with several state variables need, for queries started inside."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


class RunPlateau(StatefulProcessor):
    """Emits a run when it should stop, once; later rows of it are dropped unread."""

    def __init__(self, names: Sequence[str], step: str, value: str, patience: int, threshold: float, reorder: int, hold: bool):
        self.names, self.step, self.value = list(names), step, value
        self.patience, self.threshold, self.reorder, self.hold = patience, threshold, reorder, hold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("plateau", STATE)
        self.stopped = handle.getValueState("stopped", T.StructType().add("at", T.LongType()))
        self.waiting = handle.getListState("waiting", WAITING)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.stopped.exists():
            for _ in rows:
                pass
            return
        best, best_at, seen, last, late = self.state.get() if self.state.exists() else (None, 0, 0, None, 0)
        run, heap = Plateau(best, best_at or 0), [tuple(x) for x in self.waiting.get()] if self.waiting.exists() else []
        heapq.heapify(heap)

        def take() -> None:
            nonlocal seen, last, late
            step, value = heapq.heappop(heap)
            late += last is not None and step < last  # it came after its turn
            last = step if last is None else max(last, step)
            seen += 1
            run.see(seen, value, self.patience, self.threshold)

        for frame in rows:
            for step, value in zip(frame[self.step].to_numpy().tolist(), frame[self.value].to_numpy().tolist()):
                if value is None or value != value:
                    continue
                heapq.heappush(heap, (int(step), float(value)))
                if len(heap) > self.reorder:
                    take()
        while heap and not self.hold:
            take()
        run.settle(seen, self.patience)
        if run.stopped_at is not None:
            self.stopped.update((run.stopped_at,))
            self.state.clear()
            self.waiting.clear()
            yield pd.DataFrame([[*key, run.best, run.stopped_at, late]], columns=self.names)
            return
        self.state.update((run.best, run.best_at, seen, last, late))
        if heap:
            self.waiting.put(heap)
        elif self.waiting.exists():
            self.waiting.clear()

    def close(self) -> None:
        pass


def stateful_plateau(
    stream: DataFrame, by: Sequence[str], step: str, value: str, patience: int = 3, threshold: float = 0.001, reorder: int = 10_000, hold: bool = False
) -> DataFrame:
    """by, best, stop_evaluation and late_rows of every run that should stop; smaller values are better.

    Without ``hold`` a batch is taken whole: its rows come after those of earlier batches. With it, the last
    ``reorder`` rows of a run wait for later ones. ``late_rows`` counts rows that came after their turn
    nevertheless; they are taken where they came. Start the query inside :func:`rocksdb_state`.
    """
    by = list(by)
    out = T.StructType([stream.schema[c] for c in by]).add("best", T.DoubleType()).add("stop_evaluation", T.LongType()).add("late_rows", T.LongType())
    processor = RunPlateau(out.names, step, value, patience, threshold, reorder, hold)
    return stream.select(*by, step, value).groupBy(*by).transformWithStateInPandas(processor, out, "Append", "None")
