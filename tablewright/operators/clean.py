"""Cleaning: white space, Unicode form, markup, custom steps."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import text as tx

CLEANERS: dict[str, Callable[[Column], Column]] = {
    "strip": tx.strip,
    "remove_tags": tx.remove_tags,
    "lower": F.lower,
    "squeeze": lambda c: F.regexp_replace(c, rf"[{tx.SPACE}]+", " "),
}


def register_cleaner(name: str, fn: Callable[[Column], Column]) -> None:
    CLEANERS[name] = fn


def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


# deterministic, Arrow batched; Spark has no expression for compatibility forms
nfkc = F.pandas_udf(_nfkc, T.StringType())


def drop_any_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)


def clean(
    df: DataFrame,
    strip: bool = True,
    unicode_form: bool = False,
    markup: bool = True,
    custom: Sequence[str] = (),
    drop_nulls: bool = True,
) -> DataFrame:
    """Strip, normalise and remove tags on every string column, then drop nulls.

    Only custom steps can make a null of a value. Without them the nulls go first: a filter on cleaned
    columns would clean them once more for itself.
    """
    unknown = [n for n in custom if n not in CLEANERS]
    if unknown:
        raise ValueError(f"Unknown cleaners: {unknown}. Available: {sorted(CLEANERS)}")
    steps: list[Callable[[Column], Column]] = []
    if strip:
        steps.append(tx.strip)
    if unicode_form:
        steps.append(nfkc)
    if markup:
        steps.append(tx.remove_tags)
    steps += [CLEANERS[n] for n in custom]
    apply = tx.compose(*steps)
    if drop_nulls and not custom:
        df = drop_any_null(df)
    cleaned = df.select(
        *[
            apply(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    return drop_any_null(cleaned) if drop_nulls and custom else cleaned


def inject_noise(
    df: DataFrame,
    column: str,
    row_id: str,
    prob: float = 0.1,
    kinds: Sequence[str] = ("delete", "insert", "swap"),
    seed: int = 42,
) -> DataFrame:
    """Words deleted, doubled or swapped with the next one, decided by a seeded hash.

    Each position draws one number; the kinds share the interval [0, prob).
    """
    known = ("delete", "insert", "swap")
    if not kinds or any(k not in known for k in kinds):
        raise ValueError(f"noise kinds are {known}")
    share = prob / len(kinds)
    tokens = tx.words(column)
    draws = F.transform(
        tokens,
        lambda t, i: F.conv(
            F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string"), F.lit(":"), i.cast("string"))), 1, 8),
            16,
            10,
        ).cast("double")
        / F.lit(float(16**8)),
    )
    tagged = F.arrays_zip(tokens.alias("w"), draws.alias("u"))

    def hit(u: Column, kind: str) -> Column:
        if kind not in kinds:
            return F.lit(False)
        k = list(kinds).index(kind)
        return (u >= share * k) & (u < share * (k + 1))

    # A swap moves the word behind its right neighbour: sort by the shifted position.
    moved = F.transform(
        tagged,
        lambda x, i: F.struct(
            (i.cast("double") + F.when(hit(x["u"], "swap"), F.lit(1.5)).otherwise(F.lit(0.0))).alias("at"),
            F.when(hit(x["u"], "delete"), F.array().cast("array<string>"))
            .when(hit(x["u"], "insert"), F.array(x["w"], x["w"]))
            .otherwise(F.array(x["w"]))
            .alias("out"),
        ),
    )
    out = F.flatten(F.transform(F.array_sort(moved), lambda x: x["out"]))
    return df.withColumn(column, F.array_join(out, " "))
