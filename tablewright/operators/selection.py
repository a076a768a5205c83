"""Exact selection of rows by rank without ordering the table.

``values_at`` finds the values at given ranks of every group by counting: a row falls into one
of some intervals of its value, the rows of each interval are counted before their shuffle, and
only those in an interval that holds a wanted rank are looked at again, equal ones as one.
``first_per_group`` keeps the first k rows of each group in the tasks before they meet.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.scan import bounds_of, chunk_count, chunk_of
from tablewright.operators.sized import fixed, lookup

#: Spark limits groups in the tasks up to so many rows
GROUP_LIMIT = 1000


def values_at(
    df: DataFrame, group: Sequence[str], value: str, wanted: Callable[[Column], Column]
) -> DataFrame:
    """One row for each group and wanted rank: the group columns, the fields of ``wanted``,
    ``_total`` and the value at rank ``k``.

    ``wanted`` maps the number of a group's values to an array of structs with a field ``k``, the rank
    from 0; ranks outside the group have no row. Null values do not count; null groups do.
    """
    rows = df.filter(F.col(value).isNotNull()).select(F.struct(*group, F.lit(0).alias("_all")).alias("_group"), F.col(value).alias("_v"))
    key = F.struct("_group", "_v")
    rows = rows.withColumn("_chunk", chunk_of(key, bounds_of(rows, key, chunk_count(rows))))

    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        rows.groupBy("_group", "_chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(whole))
    )
    spots = (
        counts.select("*", F.explode(wanted(F.col("_total"))).alias("_spot"))
        .filter((F.col("_spot.k") >= F.col("_before")) & (F.col("_spot.k") < F.col("_before") + F.col("_n")))
        .groupBy("_group", "_chunk")
        .agg(F.first("_before").alias("_before"), F.first("_total").alias("_total"), F.first("_n").alias("_n"), F.collect_list("_spot").alias("_spots"))
    )
    spots = fixed(spots)
    near = lookup(rows, spots.select("_group", "_chunk", "_n"), ["_group", "_chunk"], "inner", weight="_n")
    counted = near.groupBy("_group", "_chunk", "_v").agg(F.count(F.lit(1)).alias("_times"))
    inside = Window.partitionBy("_group", "_chunk").orderBy("_v")
    upto = counted.withColumn("_upto", F.sum("_times").over(inside))
    found = upto.join(spots.drop("_n"), ["_group", "_chunk"]).select(
        "_group", "_v", "_total", (F.col("_before") + F.col("_upto")).alias("_upto"), "_times", F.explode("_spots").alias("_spot")
    )
    hit = (F.col("_spot.k") < F.col("_upto")) & (F.col("_spot.k") >= F.col("_upto") - F.col("_times"))
    return found.filter(hit).select(*[F.col("_group")[g].alias(g) for g in group], "_spot.*", "_total", F.col("_v").alias(value))


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    """The first k rows of every group, numbered from 1. Up to ``GROUP_LIMIT`` rows, tasks keep no
    more than k of a group before the shuffle."""
    if not by:
        df = df.orderBy(*order).limit(k)  # k rows of each task meet
    window = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
