"""Running values, neighbours and row numbers over ordered groups of any size.

A plain window sends a whole group to one task. Here a group is cut into *chunks*: a fixed
sample of (group, order) keys gives bounds, one for each shuffle partition up to ``MAX_CHUNKS``, and a row's
chunk is the number of bounds up to its key. Windows run inside (group, chunk), for which the
wide rows are exchanged once. What a chunk inherits from the earlier ones of its group is a
carry row. Only a group that holds a bound can have several chunks, so the carry rows come
from the rows of these groups, narrow and aggregated before their shuffle, and are no more
than two for each bound: that table is broadcast.

The bounds are literals of the plan, so a row has the same chunk whenever it is computed again; where
they lie only settles how even the chunks are. ``df`` is read three times, twice for its key and value
columns only; store it before if it is dear to compute.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import durable

_OWN = "__scan_"  # no caller's column may start like this
_KEY, _CHUNK = f"{_OWN}key", f"{_OWN}chunk"
_SPANS = f"{_OWN}spans"
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above these bits
DIRECTED = re.compile(r" (ASC|DESC) NULLS (FIRST|LAST)'>$")
SAMPLES_PER_CHUNK = 40
MAX_CHUNKS = 1024


@dataclass(frozen=True)
class RowNumber:
    """1-based position in the group."""

    name: str


@dataclass(frozen=True)
class Running:
    """Sum, min, max or count of the rows so far, with or without the current one."""

    name: str
    how: str
    value: Column
    inclusive: bool = True


@dataclass(frozen=True)
class Neighbour:
    """The value one row before (-1) or after (+1)."""

    name: str
    value: Column
    offset: int = -1


_AGG = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def _combine(how: str, carried: Column, local: Column) -> Column:
    if how == "min":
        return F.least(carried, local)
    if how == "max":
        return F.greatest(carried, local)
    return F.coalesce(carried + local, carried, local)


def bounds_of(df: DataFrame, key: Column, chunks: int) -> list[Column]:
    """Keys, as struct literals in ascending order, that cut ``df`` into about ``chunks`` even ranges.

    The sample is the ``SAMPLES_PER_CHUNK * chunks`` rows with the smallest hashes, kept by each
    task before they meet; the bounds alone go to the driver. A literal may differ from the key it was
    taken from in its order part, as where time zones do: it is a bound all the same.
    """
    if chunks < 2:
        return []
    sample = df.select(key.alias("key")).orderBy(F.xxhash64("key")).limit(SAMPLES_PER_CHUNK * chunks)
    n = F.size("keys")
    cut = F.transform(F.sequence(F.lit(1), F.lit(chunks - 1)), lambda i: F.col("keys")[F.floor(i * n / chunks).cast("int")])
    ordered = sample.agg(F.sort_array(F.collect_list("key")).alias("keys"))
    found = ordered.select(F.when(n > 0, F.array_distinct(cut)).alias("cut")).first()["cut"] or []
    fields = sample.schema["key"].dataType

    def literal(row: Row, kind: T.StructType) -> Column:
        parts = (literal(row[f.name], f.dataType) if isinstance(f.dataType, T.StructType) and row[f.name] is not None else F.lit(row[f.name]).cast(f.dataType) for f in kind)
        return F.struct(*[p.alias(f.name) for p, f in zip(parts, kind)])

    return [literal(row, fields) for row in found]


def chunk_of(key: Column, bounds: list[Column]) -> Column:
    """How many bounds are not above the key, by halving: compiled comparisons, as many as the logarithm
    of the bounds."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < bounds[middle], between(low, middle)).otherwise(between(middle + 1, high))

    return between(0, len(bounds))


def chunk_count(df: DataFrame) -> int:
    return min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_CHUNKS)


def scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    *specs: RowNumber | Running | Neighbour,
) -> DataFrame:
    """``df`` plus one column per spec. ``order`` must be unique inside a group. It is ascending with nulls
    first; where one of its columns has a direction of its own, as after ``desc()``, the rows are range
    partitioned and stored instead, because only Spark's own layout compares such keys."""
    group = list(group)
    if any(c.startswith(_OWN) for c in df.columns):
        raise ValueError(f"column names must not start with {_OWN}")
    bounds: list[Column] | None = None
    if any(isinstance(o, Column) and DIRECTED.search(str(o)) for o in order):
        keyed = _laid_out(df, [*group, *order])
    else:
        parts = [F.col(g).alias(f"g{i}") for i, g in enumerate(group)]
        parts += [(F.col(o) if isinstance(o, str) else o).alias(f"o{i}") for i, o in enumerate(order)]
        key = F.struct(*parts)
        bounds = bounds_of(df, key, chunk_count(df))
        keyed = df.withColumn(_KEY, key).withColumn(_CHUNK, chunk_of(F.col(_KEY), bounds))
    pos = F.col(_KEY)

    inside = Window.partitionBy(*group, _CHUNK).orderBy(pos)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    # at most two rows for each bound reach these windows
    across = Window.partitionBy(*(group or [F.lit(0)])).orderBy(_CHUNK)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)

    local, per_chunk, carried, final = [], [], [], []
    for i, s in enumerate(specs):
        loc, agg, car = f"{_OWN}local{i}", f"{_OWN}agg{i}", f"{_OWN}carry{i}"
        if isinstance(s, RowNumber):
            local.append(F.row_number().over(inside).cast("long").alias(loc))
            per_chunk.append(F.count(F.lit(1)).alias(agg))
            carried.append(F.sum(agg).over(earlier).alias(car))
            final.append((F.col(loc) + F.coalesce(F.col(car), F.lit(0))).alias(s.name))
        elif isinstance(s, Running):
            window = so_far if s.inclusive else before
            local.append(_AGG[s.how](s.value).over(window).alias(loc))
            per_chunk.append(_AGG[s.how](s.value).alias(agg))
            fold = "sum" if s.how == "count" else s.how
            carried.append(_AGG[fold](agg).over(earlier).alias(car))
            final.append(_combine(s.how, F.col(car), F.col(loc)).alias(s.name))
        else:
            # A struct tells a null neighbour from a missing one.
            boxed = F.struct(s.value.alias("v"))
            shift, edge = (F.lag, F.max_by) if s.offset < 0 else (F.lead, F.min_by)
            local.append(shift(boxed).over(inside).alias(loc))
            per_chunk.append(edge(boxed, pos).alias(agg))
            carried.append(shift(agg).over(across).alias(car))
            final.append(F.coalesce(F.col(loc), F.col(car)).getField("v").alias(s.name))

    names = [f"{_OWN}group{i}" for i in range(len(group))]
    same = lambda side: [F.col(g).eqNullSafe(side[n]) for g, n in zip(group, names)]
    long = keyed
    if group and bounds is not None:
        if bounds:
            held = df.sparkSession.range(1).select(F.explode(F.array(*bounds)).alias("k"))
            held = held.select(*[F.col(f"k.g{i}").alias(n) for i, n in enumerate(names)]).distinct()
            held = F.broadcast(held)  # fewer rows than bounds
            long = keyed.join(held, _all(same(held)), "left_semi")
        else:
            long = keyed.limit(0)
    carry = (
        long.groupBy(*group, _CHUNK)
        .agg(*per_chunk)
        .select(*[F.col(g).alias(n) for g, n in zip(group, names)], F.col(_CHUNK).alias(f"{_OWN}to"), *carried)
    )
    if bounds is None:
        carry = carry.withColumn(_SPANS, F.count(F.lit(1)).over(Window.partitionBy(*(names or [F.lit(0)])))).filter(F.col(_SPANS) > 1).drop(_SPANS)
    on = _all([F.col(_CHUNK) == F.col(f"{_OWN}to"), *same(carry)])
    return (
        keyed.select("*", *local)
        .join(F.broadcast(carry), on, "left")
        .select(*[F.col(c) for c in df.columns], *final)
    )


def _laid_out(df: DataFrame, layout: Sequence[str | Column]) -> DataFrame:
    """``df`` range partitioned and stored, with a row's place as key and its partition as chunk."""
    laid = df.repartitionByRange(*layout).sortWithinPartitions(*layout).withColumn(_KEY, F.monotonically_increasing_id())
    return durable(laid.withColumn(_CHUNK, F.shiftright(_KEY, _LOCAL_BITS)))


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
