"""Profiles of text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import text as tx
from tablewright.functions.language import detect_language
from tablewright.operators.cuts import seeded_key, with_cuts
from tablewright.operators.dedup import duplicate_count
from tablewright.operators.selection import values_at
from tablewright.operators.tokens import PERCENTILES, count_statistics, percentile_list


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def long_form(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per record and column: ``(by…, column, value)``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    return df.select(*by, F.inline(pairs))


def length_stats(
    df: DataFrame, columns: Sequence[str], points: Sequence[float] = PERCENTILES, by: Sequence[str] = (),
    approximate: bool = False,
) -> DataFrame:
    """Character lengths per column: count, mean, std, bounds and percentiles."""
    lengths = F.array(*[F.struct(F.lit(c).alias("column"), F.length(c).alias("size")) for c in columns])
    long = df.select(*by, F.inline(lengths))
    fractions = [p / 100.0 for p in points]
    spread = (
        F.percentile_approx("size", fractions, 10_000) if approximate else percentile_list("size", points)
    )
    return (
        long.groupBy(*by, "column")
        .agg(
            F.count("size").alias("n"),
            F.avg("size").alias("mean"),
            F.stddev_pop("size").alias("std"),
            F.min("size").alias("min"),
            F.max("size").alias("max"),
            spread.alias("_p"),
        )
        .select("*", *[F.col("_p")[i].alias(f"p{p:g}") for i, p in enumerate(points)])
        .drop("_p")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, columns without any left out."""
    return _counted(df, {c: F.col(c).isNull() for c in df.columns}, "n_null")


def empty_counts(df: DataFrame) -> DataFrame:
    """Blank strings per column, columns without any left out."""
    return _counted(df, {c: tx.is_blank(c) for c in string_columns(df)}, "n_empty")


def _counted(df: DataFrame, tests: dict[str, Column], name: str) -> DataFrame:
    one_pass = df.agg(*[F.count_if(t).alias(c) for c, t in tests.items()])
    return long_form(one_pass, list(tests)).withColumnRenamed("value", name).filter(F.col(name) > 0)


def profile(df: DataFrame, columns: Sequence[str], points: Sequence[float] = PERCENTILES) -> DataFrame:
    """All statistics of a table in long form: ``(section, column, stat, value)``."""

    def facts(frame: DataFrame, section: str, column: Column, stats: Sequence[str]) -> DataFrame:
        pairs = F.array(
            *[F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value")) for s in stats]
        )
        return frame.select(F.lit(section).alias("section"), column.alias("column"), F.inline(pairs))

    # sizes, nulls and blanks come from one pass, lengths from a second one
    blanks = string_columns(df)
    facts_of = {("shape", "*", "num_samples"): F.count(F.lit(1)), ("shape", "*", "num_columns"): F.lit(len(df.columns))}
    facts_of |= {("nulls", c, "n_null"): F.count_if(F.col(c).isNull()) for c in df.columns}
    facts_of |= {("blanks", c, "n_empty"): F.count_if(tx.is_blank(c)) for c in blanks}
    counted = df.agg(*[e.cast("double").alias(f"_f{i}") for i, e in enumerate(facts_of.values())])
    entries = [
        F.struct(F.lit(s).alias("section"), F.lit(c).alias("column"), F.lit(k).alias("stat"), F.col(f"_f{i}").alias("value"))
        for i, (s, c, k) in enumerate(facts_of)
    ]
    out = counted.select(F.inline(F.array(*entries))).filter("section = 'shape' OR value > 0")
    lengths = length_stats(df, columns, points)
    out = out.unionByName(
        facts(lengths, "length", F.col("column"), [c for c in lengths.columns if c != "column"])
    )
    if "input_ids" in df.columns:
        sizes = count_statistics(df, F.size("input_ids"), "tokens")
        out = out.unionByName(facts(sizes, "tokens", F.lit("*"), sizes.columns))
    return out


def full_profile(
    df: DataFrame, columns: Sequence[str], subset: Sequence[str] | None = None, text: str | None = None, points: Sequence[float] = PERCENTILES
) -> DataFrame:
    """``profile`` and, in the same long form: the columns' names with their places, the rows that a dedup on
    ``subset`` removes, the lengths of all ``columns`` together, and the languages of ``text``."""
    out = profile(df, columns, points)

    def more(frame: DataFrame, section: str, column: Column, stat: Column, value: Column) -> DataFrame:
        return frame.select(F.lit(section).alias("section"), column.alias("column"), stat.alias("stat"), value.cast("double").alias("value"))

    names = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.lit(i).alias("i")) for i, c in enumerate(df.columns)])).alias("x")
    places = df.sparkSession.range(1).select(names)
    out = out.unionByName(more(places, "columns", F.col("x.c"), F.lit("place"), F.col("x.i")))
    repeated = duplicate_count(df.withColumn("_all", F.lit(0)), subset or columns, ["_all"])
    out = out.unionByName(more(repeated, "duplicates", F.lit("*"), F.lit("n_duplicates"), F.col("n_duplicates")))
    size = sum((F.coalesce(F.length(F.col(c)), F.lit(0)) for c in columns[1:]), F.coalesce(F.length(F.col(columns[0])), F.lit(0)))
    whole = df.agg(
        F.avg(size).alias("mean"), F.stddev_pop(size).alias("std"), F.min(size).alias("min"), F.max(size).alias("max"), F.sum(size.cast("long")).alias("sum")
    )
    facts = F.explode(F.array(*[F.struct(F.lit(c).alias("stat"), F.col(c).cast("double").alias("value")) for c in whole.columns])).alias("x")
    out = out.unionByName(more(whole.select(facts), "total_length", F.lit("*"), F.col("x.stat"), F.col("x.value")))
    if text is not None:
        out = out.unionByName(more(language_distribution(df, text), "languages", F.lit(text), F.col("detected"), F.col("n")))
    return out


#: a bound found among so many keys of each task
FEW_ROWS = 20_000


def sample_rows(df: DataFrame, n: int = 10_000, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """The n rows with the smallest seeded keys, found without a global sort: up to ``FEW_ROWS`` the last of
    them comes from one pass over the ids, of which tasks keep n."""
    if 0 < n <= FEW_ROWS:
        here = F.struct(seeded_key(row_id, seed).alias("key"), F.col(row_id).alias("row_id"))
        ids = df.filter(F.col(row_id).isNotNull()).select(here.alias("k"))
        last = ids.orderBy("k").limit(n).agg(F.max("k").alias("k")).first()
        if last["k"] is None:
            return df.limit(0)
        return df.filter(here <= F.struct(F.lit(last["k"]["key"]).alias("key"), F.lit(last["k"]["row_id"]).cast(df.schema[row_id].dataType).alias("row_id")))
    return with_cuts(df, row_id, seed, lambda total: {"_in": F.lit(n)}).filter("_in").drop("_in")


def language_distribution(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return (
        df.select(*by, detect_language(column).alias("detected"))
        .groupBy(*by, "detected")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def word_length_stats(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return count_statistics(df, tx.word_count(column), "length", by)


def dataset_fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and a sum of row hashes, independent of row order and partitions."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("null;")) for c in columns]
    number = F.conv(F.substring(F.md5(F.concat(*parts)), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(number).cast("string").alias("fingerprint")
    )


def top_k(df: DataFrame, by: str, k: int, tie: str, largest: bool = True) -> DataFrame:
    order = F.col(by).desc() if largest else F.col(by).asc()
    return df.orderBy(order, F.col(tie).asc()).limit(k)


def exact_percentiles(
    df: DataFrame, group: Sequence[str], value: str, points: Sequence[float]
) -> DataFrame:
    """Linear percentiles of a column with any number of distinct values, found by counting.

    A null group has percentiles like any other.
    """
    group = list(group)

    def wanted(total: Column) -> Column:
        spots = []
        for p in map(float, points):
            spot = F.lit(p) / 100.0 * (total - 1)
            spots += [F.struct(F.lit(p).alias("p"), spot.alias("_spot"), f(spot).cast("long").alias("k")) for f in (F.floor, F.ceil)]
        return F.array(*spots)

    near = values_at(df, group, value, wanted).groupBy(*group, "p").agg(
        F.first("_spot").alias("_spot"), F.min(value).alias("_lo"), F.max(value).alias("_hi")
    )
    weight = F.col("_spot") - F.floor("_spot")
    return near.select(*group, "p", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * weight).alias("value"))
