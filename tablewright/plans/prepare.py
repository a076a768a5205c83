"""The stages of data preparation, stored where they are read more than once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.operators import clean as cl
from tablewright.operators import dedup as dd
from tablewright.operators import split as sp
from tablewright.operators import templates as tp
from tablewright.operators import tokens as tk
from tablewright.operators import validate as va
from tablewright.session import durable
from tablewright.sources import readers as rd


@dataclass(frozen=True)
class Settings:
    """Options of a preparation run."""

    rules: va.Rules = va.Rules()
    strip: bool = True
    unicode_form: bool = False
    markup: bool = True
    cleaners: Sequence[str] = ()
    duplicates: Sequence[str] = dd.DEFAULT_SUBSET
    template: str = "alpaca"
    template_options: Mapping[str, object] = field(default_factory=dict)
    eos: str = ""
    keep_columns: bool = False
    tokenize: bool = False
    vocabulary: int = 32_000
    max_length: int = 2048
    split: str = "random"
    stratify_by: str | None = None
    ratios: Mapping[str, float] = field(default_factory=lambda: dict(sp.DEFAULT_RATIOS))
    minimums: Mapping[str, int] = field(default_factory=lambda: dict(sp.DEFAULT_MINIMUMS))
    seed: int = 42


def prepare(df: DataFrame, settings: Settings = Settings(), row_id: str = "row_id") -> DataFrame:
    """Records to split, formatted and optionally encoded rows.

    Cleaning decides the same for equal rows, so one dedup after it is enough. Dedup and splits read
    the rows several times, so what precedes them is stored.
    """
    s = settings
    rows = va.validate(df, s.rules)
    rows = cl.clean(rows, s.strip, s.unicode_form, s.markup, s.cleaners)
    rows = dd.dedup(durable(rows), s.duplicates, row_id)
    kept = [row_id, *[c for c in ("dataset", s.stratify_by) if c and c in rows.columns]]
    rows = tp.format_table(
        rows, s.template, keep_columns=s.keep_columns, ids=list(dict.fromkeys(kept)), eos=s.eos, **s.template_options
    )
    rows = durable(rows)
    if s.tokenize:
        vocab = tk.build_vocab(rows, "text", s.vocabulary)
        rows = tk.encode(rows.withColumn("_text", F.col("text")), "_text", vocab, row_id, s.max_length)
    if s.split == "stratified":
        if s.stratify_by is None:
            raise ValueError("a stratified split needs stratify_by")
        return sp.split_stratified(rows, s.stratify_by, s.ratios, s.seed, row_id)
    if s.split == "sequential":
        return sp.split_sequential(rows, s.ratios, s.minimums, row_id)
    if s.split == "hash":
        return sp.split_hash(rows, s.ratios, s.seed, row_id)
    if s.split != "random":
        raise ValueError("split must be random, sequential, stratified or hash")
    return sp.split_random(rows, s.ratios, s.seed, s.minimums, row_id)


def prepare_conversations(spark: SparkSession, turns: DataFrame, ratios: Mapping[str, float]) -> DataFrame:
    """Chat turns to split training texts."""
    records = rd.conversations_to_pairs(turns).select(
        (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("row_id"), "instruction", "input", "output"
    )
    return prepare(records, Settings(ratios=dict(ratios)))
