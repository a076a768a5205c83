"""Exact selection of the first k rows in a seeded order, without sorting the table.

The order key is ``md5(seed:row_id)``. Its leading hex digits are even buckets
whatever the skew of the data, so the k-th key of a group is found by counting the
buckets, and ranking only the bucket in which the k-th row falls. The caller then
compares every row with that key: the wide table is neither shuffled nor sorted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.sized import lookup, pinned

_ROWS_PER_BUCKET = 250_000


def seeded_key(row_id: str | Column, seed: int | Column) -> Column:
    """The reproducible shuffle key of a row."""
    col = F.col(row_id) if isinstance(row_id, str) else row_id
    prefix = F.lit(f"{seed}:") if isinstance(seed, int) else F.concat(seed.cast("string"), F.lit(":"))
    return F.md5(F.concat(prefix, col.cast("string")))


def unit_interval(key: Column) -> Column:
    """A key mapped to [0, 1) by its first eight hex digits."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(float(16**8))


def cut_keys(
    df: DataFrame,
    row_id: str,
    seed: int | Column,
    cuts: Callable[[Column], dict[str, Column]],
    group: Sequence[str] = (),
) -> DataFrame:
    """The key of the k-th row for every named cut: one row per group.

    ``cuts`` maps the size of a group to named row counts k, ``seed`` may depend on the group. The
    result has the group columns, ``_total``, and per name a struct ``(key, row_id)``: null for k = 0.
    """
    group = list(group)
    keys = df.select(*group, F.col(row_id).alias("_id"))
    if not group:
        group = ["_all"]
        keys = keys.withColumn("_all", F.lit(0))
    columns = keys.columns
    if not isinstance(seed, int) and group == ["_group"]:
        keys = keys.select("*", "_group.*")  # the seed is one of the group's columns
    keys = keys.withColumn("_key", seeded_key("_id", seed)).select(*columns, "_key")
    total = keys.count()
    digits = min(5, max(1, math.ceil(math.log(max(total / _ROWS_PER_BUCKET, 1.0001), 16))))
    keys = keys.withColumn("_bucket", F.substring("_key", 1, digits))

    # At most 16**digits rows per group reach these windows, whatever the group holds.
    whole = Window.partitionBy(*group)
    ordered = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        keys.groupBy(*group, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(ordered), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(whole))
    )
    if list(group) == ["_group"]:
        buckets = buckets.select("*", "_group.*")  # the cuts may depend on the group
    named = cuts(F.col("_total"))
    wanted = F.array(
        *[
            F.struct(F.lit(n).alias("name"), F.least(k.cast("long"), F.col("_total")).alias("k"))
            for n, k in named.items()
        ]
    )
    edges = (
        buckets.select("*", F.explode(wanted).alias("_cut"))
        .filter("_cut.k = 0 AND _before = 0 OR _cut.k > _before AND _cut.k <= _before + _n")
        .select(
            *group,
            "_bucket",
            "_total",
            F.col("_cut.name").alias("_name"),
            (F.col("_cut.k") - F.col("_before")).alias("_rank"),
        )
    )
    edges = pinned(edges)
    inside = Window.partitionBy(*group, "_bucket", "_name").orderBy("_key", "_id")
    found = (
        keys.join(edges, [*group, "_bucket"])
        .withColumn("_rn", F.row_number().over(inside))
        .filter("_rn = greatest(_rank, 1)")
        .groupBy(*group)
        .agg(
            F.first("_total").alias("_total"),
            *[
                F.max(
                    F.when(
                        (F.col("_name") == n) & (F.col("_rank") > 0),
                        F.struct(F.col("_key").alias("key"), F.col("_id").alias("row_id")),
                    )
                ).alias(n)
                for n in named
            ],
        )
    )
    return found


def with_cuts(
    df: DataFrame,
    row_id: str,
    seed: int,
    cuts: Callable[[Column], dict[str, Column]],
    group: Sequence[str] = (),
    total: str | None = None,
) -> DataFrame:
    """``df`` plus a boolean column per cut: is the row among the first k of its group? With ``total``,
    groups also get their size under this name."""
    names = list(cuts(F.lit(1)))
    columns = df.columns
    if group:
        # a struct is never null itself, so a null group is matched as any other
        df = df.withColumn("_group", F.struct(*group))
        group = ["_group"]
    keys = cut_keys(df, row_id, seed, cuts, group)
    here = F.struct(seeded_key(row_id, seed).alias("key"), F.col(row_id).alias("row_id"))
    flags = [F.coalesce(here <= F.col(f"_cut_{n}"), F.lit(False)).alias(n) for n in names]
    keys = keys.withColumnsRenamed({n: f"_cut_{n}" for n in names})
    if group:
        joined = lookup(df, keys, list(group), weight="_total")
    else:
        # without groups there is one row of keys, which becomes literals
        found = keys.first()
        bounds = {}
        for n in names:
            edge = None if found is None else found[f"_cut_{n}"]
            bounds[f"_cut_{n}"] = (
                F.lit(None).cast(keys.schema[f"_cut_{n}"].dataType)
                if edge is None
                else F.struct(F.lit(edge["key"]).alias("key"), F.lit(edge["row_id"]).alias("row_id"))
            )
        joined = df.withColumns(bounds)
    size = [F.col("_total").alias(total)] if total and group else []
    return joined.select(*[F.col(c) for c in columns], *size, *flags)
