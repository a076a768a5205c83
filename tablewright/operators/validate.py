"""Record validation and row filters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import text as tx
from tablewright.functions.language import detect_language
from tablewright.operators.sized import lookup


@dataclass(frozen=True)
class Rules:
    """What a record must satisfy; lengths are inclusive and count code points."""

    required: Sequence[str] = ("instruction", "output")
    drop_nulls: bool = True
    drop_blank: bool = True
    instruction_length: tuple[int, int] = (10, 8192)
    output_length: tuple[int, int] = (5, 16384)


def require_columns(df: DataFrame, columns: Sequence[str], name: str = "dataset") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns in {name}: {missing}")
    return df


def drop_null_required(df: DataFrame, columns: Sequence[str] = ("instruction", "output")) -> DataFrame:
    return df.na.drop("any", subset=list(columns))


def drop_blank_required(df: DataFrame, columns: Sequence[str] = ("instruction", "output")) -> DataFrame:
    for c in columns:
        df = df.filter(~tx.is_blank(c))
    return df


def length_bounds(
    df: DataFrame,
    instruction: tuple[int, int] = (10, 8192),
    output: tuple[int, int] = (5, 16384),
) -> DataFrame:
    return df.filter(F.length("instruction").between(*instruction) & F.length("output").between(*output))


def reject_reason(rules: Rules = Rules()) -> Column:
    """The first rule a record breaks, null for a valid record."""
    instruction, output = F.col("instruction"), F.col("output")
    reasons = []
    if rules.drop_nulls:
        reasons.append(F.when(instruction.isNull() | output.isNull(), F.lit("null_required")))
    if rules.drop_blank:
        reasons.append(F.when(tx.is_blank(instruction) | tx.is_blank(output), F.lit("blank_required")))
    reasons.append(F.when(~F.length(instruction).between(*rules.instruction_length), F.lit("instruction_length")))
    reasons.append(F.when(~F.length(output).between(*rules.output_length), F.lit("output_length")))
    return F.coalesce(*reasons)


def validate(df: DataFrame, rules: Rules = Rules(), name: str = "dataset") -> DataFrame:
    """The valid records."""
    require_columns(df, rules.required, name)
    return df.filter(reject_reason(rules).isNull())


def rejected(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The invalid records with the reason."""
    return df.withColumn("reason", reject_reason(rules)).filter(F.col("reason").isNotNull())


def reject_counts(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return rejected(df, rules).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def length_ratio_filter(df: DataFrame, low: float = 0.1, high: float = 10.0) -> DataFrame:
    ratio = F.length("output") / F.length("instruction")
    return df.filter(ratio.between(low, high))


def repetition_ratio(c: str | Column, n: int = 4) -> Column:
    """Share of n-grams that repeat an earlier one; 0 for texts without n-grams."""
    return tx.let(
        tx.ngrams(tx.words(c), n),
        lambda g: F.when(F.size(g) > 0, 1 - F.size(F.array_distinct(g)) / F.size(g)).otherwise(F.lit(0.0)),
    )


def repetition_filter(df: DataFrame, column: str, n: int = 4, max_ratio: float = 0.5) -> DataFrame:
    return df.filter(repetition_ratio(column, n) <= max_ratio)


def score_threshold_filter(df: DataFrame, scores: DataFrame, on: str, score: str, limit: float) -> DataFrame:
    """Rows whose supplied score is at most ``limit``; rows without a score stay."""
    above = scores.filter(F.col(score) > limit).select(on)
    return df.join(above, on, "left_anti")


def language_filter(df: DataFrame, column: str, expected: str) -> DataFrame:
    return df.filter(detect_language(column) == expected)


def is_eval_filter(df: DataFrame, catalog: DataFrame, evaluation: bool = False) -> DataFrame:
    """Rows of training sources, or of evaluation sources, by the catalog's flag."""
    flagged = catalog.filter("is_eval").select("dataset", F.lit(True).alias("_eval")).distinct()
    marked = lookup(df, flagged, ["dataset"])
    keep = F.col("_eval").isNotNull() if evaluation else F.col("_eval").isNull()
    return marked.filter(keep).drop("_eval")
