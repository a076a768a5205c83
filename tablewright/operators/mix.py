"""Mixing sources by weight.

Sources may be many: their sizes, weights and cuts are tables joined by source, never a list on
the driver. Weights that a caller gives become such a table too.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators.cuts import cut_keys, seeded_key, with_cuts
from tablewright.operators.scan import RowNumber, scan
from tablewright.operators.sized import lookup
from tablewright.session import durable

STRATEGIES = ("proportional", "equal", "custom")
SHOWN = 20


def weight_table(df: DataFrame, source: str, weights: Mapping[object, float] | DataFrame) -> DataFrame:
    """(source, weight) of the given weights, with the type of the source column."""
    if isinstance(weights, DataFrame):
        return weights.select(F.col(source), F.col("weight").cast("double"))
    schema = T.StructType([T.StructField(source, df.schema[source].dataType), T.StructField("weight", T.DoubleType())])
    return df.sparkSession.createDataFrame([(s, float(w)) for s, w in weights.items()], schema)


def _boxed(c: str) -> Column:
    """A column as a key that a null value matches too."""
    return F.struct(F.col(c).alias("s"))


def with_weights(df: DataFrame, source: str, weights: DataFrame, name: str) -> DataFrame:
    """``df`` with the weight of each row's source, 0 for a source without one.

    A source that is not in ``df`` is an error.
    """
    given = weights.select(_boxed(source).alias("_box"), F.col("weight").alias(name))
    sizes = df.groupBy(_boxed(source).alias("_box")).agg(F.count(F.lit(1)).alias("_n"))
    unknown = given.join(sizes, "_box", "left_anti").select("_box.s").limit(SHOWN).collect()
    if unknown or weights.isEmpty():
        raise ValueError(f"custom weights need known sources, unknown: {[r['s'] for r in unknown]}")
    known = given.join(sizes, "_box")
    joined = lookup(df.withColumn("_box", _boxed(source)), known, ["_box"], weight="_n")
    return joined.select(*df.columns, F.coalesce(name, F.lit(0.0)).alias(name))


def _wanted(df: DataFrame, strategy: str, source: str, total: int | None, whole: float | None) -> Callable[[Column], Column]:
    """The rows wanted of a source as an expression of its size, and of `_weight` if custom."""
    rows, sources = df.groupBy(source).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.count(F.lit(1))).first()
    total = (rows or 0) if total is None else total
    if strategy == "proportional":
        return lambda n: F.floor(F.lit(float(total)) * n.cast("double") / F.lit(float(rows or 1))).cast("long")
    if strategy == "equal":
        return lambda n: F.floor(F.lit(float(total)) * F.lit(1.0) / F.lit(float(sources or 1))).cast("long")
    return lambda n: F.floor(F.lit(float(total)) * F.col("_weight") / F.lit(whole)).cast("long")


def mix(
    df: DataFrame,
    strategy: str = "proportional",
    total: int | None = None,
    weights: Mapping[str, float] | DataFrame | None = None,
    source: str = "dataset",
    row_id: str = "row_id",
    seed: int = 42,
) -> DataFrame:
    """The wanted rows of each source with a ``copy`` number from 1.

    A source smaller than its target is repeated as a whole, and the rest is a seeded
    selection; the wide rows are not shuffled while sources are few. ``weights`` of the custom strategy
    are a mapping or a table of (source, weight).
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    rows, group, whole = df, [source], None
    if strategy == "custom":
        if weights is None:
            raise ValueError("custom weights are missing")
        table = weight_table(df, source, weights)
        if df.isEmpty():
            return df.withColumn("copy", F.lit(1).cast("long"))
        whole = float(table.agg(F.sum("weight")).first()[0] or 0) or 1.0
        rows, group = with_weights(df, source, table, "_weight"), [source, "_weight"]
    want = _wanted(df, strategy, source, total, whole)
    flagged = with_cuts(rows, row_id, seed, lambda n: {"_part": want(n) % n}, group, total="_size")
    copies = F.floor(want(F.col("_size")) / F.col("_size")) + F.col("_part").cast("long")
    return (
        flagged.withColumn("_copies", copies)
        .filter("_copies > 0")
        .select(*df.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("copy"))
    )


def interleave(
    df: DataFrame, stop_on_shortest: bool = False, source: str = "dataset", row_id: str = "row_id"
) -> DataFrame:
    """Round robin over the sources by name, a null one first, with the resulting ``position`` from 0.

    A row's round is its number in its source, and its position the number of rows before it by round
    and source: two scans, for any number of sources of any size.
    """
    numbered = durable(scan(df, [source], [row_id], RowNumber("_round")))
    out = scan(numbered, [], ["_round", source], RowNumber("_place")).withColumn("position", F.col("_place") - 1)
    if stop_on_shortest:
        least = df.groupBy(source).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0]
        out = out.filter(F.col("_round") <= F.lit(least))
    return out.drop("_round", "_place")


def curriculum(
    df: DataFrame,
    schedule: Sequence[tuple[int, Mapping[str, float]]],
    total_steps: int,
    batch: int,
    source: str = "dataset",
    row_id: str = "row_id",
    seed: int = 42,
) -> DataFrame:
    """Training batches whose source weights follow a schedule of (first step, weights).

    A stage lasts until the next entry; it draws ``steps * batch`` rows by its own
    weights and deals them to its steps in seeded order. The cuts of all stages are one table, found from
    the ids in one pass and joined to the rows once by source.
    """
    starts = [s for s, _ in schedule]
    if not schedule or starts != sorted(set(starts)) or starts[0] != 0:
        raise ValueError("the schedule needs rising steps that start at 0")
    stages = []
    for i, (start, weights) in enumerate(schedule):
        end = min(starts[i + 1] if i + 1 < len(starts) else total_steps, total_steps)
        if end > start:
            stages.append((i, start, (end - start) * batch, weights))
    plan = F.array(
        *[F.struct(F.lit(i).alias("stage"), F.lit(start).cast("long").alias("first"), F.lit(float(rows)).alias("rows"),
                   F.lit(seed + i).alias("seed"), F.lit(float(sum(w.values()) or 1.0)).alias("whole")) for i, start, rows, w in stages]
    )
    tables = [weight_table(df, source, w).withColumn("stage", F.lit(i)) for i, _, _, w in stages]
    given = tables[0]
    for t in tables[1:]:
        given = given.unionByName(t)
    # stage and weight of each source that some stage draws from
    by_source = given.groupBy(_boxed(source).alias("_box")).agg(F.map_from_entries(F.collect_list(F.struct("stage", "weight"))).alias("_weights"))
    sizes = df.groupBy(_boxed(source).alias("_box")).agg(F.count(F.lit(1)).alias("_n"))
    unknown = by_source.join(sizes, "_box", "left_anti").select("_box.s").limit(SHOWN).collect()
    if unknown:
        raise ValueError(f"custom weights need known sources, unknown: {[r['s'] for r in unknown]}")
    known = by_source.join(sizes, "_box")
    rows = lookup(df.withColumn("_box", _boxed(source)), known, ["_box"], "inner", weight="_n")

    staged = rows.select("_box", row_id, "_weights", F.explode(plan).alias("_s"))
    share = F.coalesce(F.try_element_at("_weights", F.col("_s.stage")), F.lit(0.0))
    staged = staged.select("_box", row_id, F.col("_s.stage").alias("stage"), F.col("_s.seed").alias("seed"), F.floor(F.col("_s.rows") * share / F.col("_s.whole")).cast("long").alias("want"))
    staged = staged.filter("want > 0").withColumn("_group", F.struct("_box", "stage", "seed", "want"))
    keys = cut_keys(staged, row_id, F.col("seed"), lambda n: {"_part": F.col("want") % n}, ["_group"])
    cuts = keys.groupBy(F.col("_group._box").alias("_box")).agg(
        F.collect_list(F.struct("_group.stage", "_group.seed", F.floor(F.col("_group.want") / F.col("_total")).alias("whole"), "_part")).alias("_cuts"),
        F.first("_total").alias("_n"),
    )
    joined = lookup(rows.drop("_weights", "_n"), cuts, ["_box"], "inner", weight="_n")

    def copies(x: Column) -> Column:
        here = F.struct(seeded_key(row_id, x["seed"]).alias("key"), F.col(row_id).alias("row_id"))
        return x["whole"] + F.coalesce(here <= x["_part"], F.lit(False)).cast("long")

    drawn = joined.select(*df.columns, F.explode(F.transform("_cuts", lambda x: F.struct(x["stage"].alias("stage"), copies(x).alias("n")))).alias("_c"))
    drawn = drawn.filter("_c.n > 0").select(*df.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_c.n"))).alias("copy"), F.col("_c.stage").alias("stage"))
    first = F.create_map(*[F.lit(x) for i, start, *_ in stages for x in (i, start)])[F.col("stage")].cast("long")

    order_key = seeded_key(F.concat_ws(":", F.col("stage").cast("string"), F.col(row_id).cast("string"), F.col("copy").cast("string")), seed)
    dealt = scan(durable(drawn.withColumn("_key", order_key)), ["stage"], ["_key", row_id, "copy"], RowNumber("_rn"))
    step = first + F.floor((F.col("_rn") - 1) / batch)
    return dealt.withColumn("step", step.cast("long")).drop("_key", "_rn")


def union_datasets(base: DataFrame, override: DataFrame, name: str = "dataset") -> DataFrame:
    """Both collections; a dataset in ``override`` replaces the one of the same name."""
    replaced = override.select(name).distinct().withColumn("_replaced", F.lit(True))
    kept = lookup(base, replaced, [name]).filter(F.col("_replaced").isNull()).drop("_replaced")
    return kept.unionByName(override, allowMissingColumns=True)
