"""Reproducible splits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.cuts import seeded_key, unit_interval, with_cuts
from tablewright.operators.scan import RowNumber, scan
from tablewright.operators.selection import GROUP_LIMIT, first_per_group, values_at
from tablewright.operators.sized import pinned

DEFAULT_RATIOS = {"train": 0.9, "validation": 0.05, "test": 0.05}
DEFAULT_MINIMUMS = {"train": 1, "validation": 1, "test": 1}
NAMES = ("train", "validation", "test")


def validate_ratios(ratios: Mapping[str, float]) -> None:
    if set(ratios) - set(NAMES):
        raise ValueError(f"split names are {NAMES}")
    if abs(sum(ratios.values()) - 1.0) > 1e-6:
        raise ValueError(f"split ratios must sum to 1, got {sum(ratios.values())}")


def _floor(c: Column) -> Column:
    return F.floor(c).cast("long")


def split_sizes(total: Column, ratios: Mapping[str, float], minimums: Mapping[str, int]) -> dict[str, Column]:
    """Row counts per split: floors of the shares, raised to the minimums where the
    table is large enough, scaled down where that asks for too many rows."""
    validate_ratios(ratios)
    n = total.cast("long")
    least = sum(minimums.values())
    share = {s: _floor(n * F.lit(float(ratios[s]))) for s in NAMES}

    tiny_train = F.greatest(F.lit(1), F.least(n, share["train"]))
    tiny_val = F.greatest(F.lit(0), F.least(n - tiny_train, share["validation"]))

    raised = {s: F.greatest(share[s], F.lit(minimums[s])) for s in NAMES}
    asked = raised["train"] + raised["validation"] + raised["test"]
    scale = n / asked
    scaled_train, scaled_val = _floor(raised["train"] * scale), _floor(raised["validation"] * scale)

    def pick(tiny: Column, scaled: Column, plain: Column) -> Column:
        return F.when(n < least, tiny).when(asked > n, scaled).otherwise(plain).cast("long")

    return {
        "train": pick(tiny_train, scaled_train, raised["train"]),
        "validation": pick(tiny_val, scaled_val, raised["validation"]),
        "test": pick(n - tiny_train - tiny_val, n - scaled_train - scaled_val, raised["test"]),
    }


def _bounds(total: Column, ratios: Mapping[str, float], minimums: Mapping[str, int]) -> dict[str, Column]:
    sizes = split_sizes(total, ratios, minimums)
    train, val = sizes["train"], sizes["validation"]
    return {"_c1": train, "_c2": train + val, "_c3": train + val + sizes["test"]}


def _name_split(df: DataFrame) -> DataFrame:
    name = F.when(F.col("_c1"), "train").when(F.col("_c2"), "validation").when(F.col("_c3"), "test")
    return df.withColumn("split", name).filter(F.col("split").isNotNull()).drop("_c1", "_c2", "_c3")


def split_random(
    df: DataFrame,
    ratios: Mapping[str, float] = DEFAULT_RATIOS,
    seed: int = 42,
    minimums: Mapping[str, int] = DEFAULT_MINIMUMS,
    row_id: str = "row_id",
) -> DataFrame:
    """A seeded split with exact sizes; rows left over by rounding get no split."""
    validate_ratios(ratios)
    return _name_split(with_cuts(df, row_id, seed, lambda n: _bounds(n, ratios, minimums)))


def split_sequential(
    df: DataFrame,
    ratios: Mapping[str, float] = DEFAULT_RATIOS,
    minimums: Mapping[str, int] = DEFAULT_MINIMUMS,
    row_id: str = "row_id",
) -> DataFrame:
    """The same sizes in id order. The three bounding ids are found by counting, and rows are
    compared with them."""
    validate_ratios(ratios)

    def wanted(total: Column) -> Column:
        return F.array(*[F.struct(F.lit(n).alias("name"), (k - 1).cast("long").alias("k")) for n, k in _bounds(total, ratios, minimums).items()])

    at = {r["name"]: r[row_id] for r in values_at(df, [], row_id, wanted).collect()}  # three rows
    names = _bounds(F.lit(0), ratios, minimums)
    flags = [
        (F.col(row_id) <= F.lit(at[n]) if n in at else F.lit(False)).alias(n) for n in names
    ]
    return _name_split(df.select("*", *flags))


def split_stratified(
    df: DataFrame, by: str, ratios: Mapping[str, float] = DEFAULT_RATIOS, seed: int = 42, row_id: str = "row_id"
) -> DataFrame:
    """Each label is divided by the ratios; the last split takes what rounding leaves."""
    validate_ratios(ratios)
    r1, r2 = float(ratios["train"]), float(ratios["train"] + ratios["validation"])

    def bounds(n: Column) -> dict[str, Column]:
        return {"_c1": _floor(n * F.lit(r1)), "_c2": _floor(n * F.lit(r2)), "_c3": n.cast("long")}

    return _name_split(with_cuts(df, row_id, seed, bounds, [by]))


def split_hash(
    df: DataFrame, ratios: Mapping[str, float] = DEFAULT_RATIOS, seed: int = 42, row_id: str = "row_id"
) -> DataFrame:
    """A split by key range: no counting, no shuffle, and old rows keep their split
    when new ones arrive."""
    validate_ratios(ratios)
    u = unit_interval(seeded_key(row_id, seed))
    r1, r2 = float(ratios["train"]), float(ratios["train"] + ratios["validation"])
    return df.withColumn("split", F.when(u < r1, "train").when(u < r2, "validation").otherwise("test"))


def shuffle(df: DataFrame, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Rows in seeded order, with their ``position`` from 0."""
    keyed = df.withColumn("_key", seeded_key(row_id, seed))
    numbered = scan(keyed, [], ["_key", row_id], RowNumber("_rn"))
    return numbered.withColumn("position", F.col("_rn") - 1).drop("_rn", "_key")


def head_n(df: DataFrame, n: int, by: str = "dataset", row_id: str = "row_id") -> DataFrame:
    """The first n rows of every dataset in id order: those up to its n-th id.

    A small n is found by what tasks keep of each dataset, a large one by counting.
    """
    if n <= 0:
        return df.limit(0)
    if n <= GROUP_LIMIT:
        nth = first_per_group(df.select(by, row_id), [by], [F.col(row_id).asc()], n, "_rn").filter(F.col("_rn") == n)
    else:
        nth = values_at(df, [by], row_id, lambda total: F.array(F.struct(F.lit(n - 1).cast("long").alias("k"))))
    bound = nth.select(F.col(by).alias("_by"), F.col(row_id).alias("_last"))
    return (
        df.join(pinned(bound), F.col(by).eqNullSafe(F.col("_by")), "left")
        .filter(F.col("_last").isNull() | (F.col(row_id) <= F.col("_last")))
        .select(*df.columns)
    )


def sample_by_label(df: DataFrame, by: str, n: int, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """n seeded rows of every category."""
    return with_cuts(df, row_id, seed, lambda total: {"_in": F.lit(n)}, [by]).filter("_in").drop("_in")
