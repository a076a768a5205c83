"""Exact deduplication on a set of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.sized import lookup, pinned
from tablewright.session import durable

DEFAULT_SUBSET = ("instruction", "input", "output")


def record_key(columns: Sequence[str]) -> Column:
    """128-bit key of a tuple of columns; parts carry their length, nulls are equal."""
    parts = [
        F.coalesce(
            F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")),
            F.lit("null;"),
        )
        for c in columns
    ]
    return F.unhex(F.md5(F.concat(*parts)))


def _present(df: DataFrame, subset: Sequence[str]) -> list[str]:
    return [c for c in subset if c in df.columns]


def dedup(df: DataFrame, subset: Sequence[str] = DEFAULT_SUBSET, row_id: str = "row_id") -> DataFrame:
    """The first row, by ``row_id``, of every distinct tuple.

    Keys and ids are aggregated without the texts, where copies collapse before the shuffle. Only keys
    that occur more than once go back to the ids, so what comes out are the ids of later copies;
    while these are few the wide rows are not shuffled at all, and never by a key that copies share.
    """
    subset = _present(df, subset)
    if not subset:
        return df
    keyed = durable(df.select(record_key(subset).alias("_key"), row_id))
    repeated = keyed.groupBy("_key").agg(F.min(row_id).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    later = lookup(keyed, repeated, ["_key"], "inner", weight="_n").filter(F.col(row_id) != F.col("_first"))
    return df.join(pinned(later.select(row_id)), row_id, "left_anti")


def duplicate_count(
    df: DataFrame, subset: Sequence[str] = DEFAULT_SUBSET, by: Sequence[str] = ("dataset",)
) -> DataFrame:
    """Rows that a dedup inside each group would remove."""
    key = record_key(_present(df, subset)).alias("_key")
    sizes = df.select(*by, key).groupBy(*by, "_key").agg(F.count(F.lit(1)).alias("_n"))
    return sizes.groupBy(*by).agg(
        F.sum("_n").alias("n_rows"), F.sum(F.col("_n") - 1).alias("n_duplicates")
    )


def duplicate_groups(
    df: DataFrame, subset: Sequence[str] = DEFAULT_SUBSET, row_id: str = "row_id"
) -> DataFrame:
    """Tuples that occur more than once: size, first and last id."""
    key = record_key(_present(df, subset)).alias("_key")
    return (
        df.select(key, row_id)
        .groupBy("_key")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(row_id).alias("first_row"),
            F.max(row_id).alias("last_row"),
        )
        .filter("n_rows > 1")
        .drop("_key")
    )


def stream_dedup(
    stream: DataFrame, subset: Sequence[str], event_time: str, delay: str = "1 hour"
) -> DataFrame:
    """Dedup on a stream; state is dropped once the watermark has passed."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(subset))
