"""The registered queries of the operators, over whole tables, with their SQL where SQL can
express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import decontaminate, divergence, html_text, jaccard, mixture, near_dups, pii, quality, repeats, resample, shards, sql, token_ids, toxicity
from tablewright.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_ids")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op2_substring_dedup", sql.REPEATS)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


@query("op3_quality_ledger")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"))


@query("op4_mix_sources")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixed(table(spark, sf_dir, "documents"))


@query("op5_html_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


@query("op6_decontaminate", sql.CONTAMINATION)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_kd_shards")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(table(spark, sf_dir, "documents"))


@query("op8_minhash_near_dups")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_pii")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.findings(table(spark, sf_dir, "documents"))


@query("op11_importance_resampling", sql.RESAMPLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_source_divergence", sql.DIVERGENCE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op13_ngram_jaccard", sql.JACCARD)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


# parts of operators that SQL can state


@query("quality_base", sql.QUALITY_BASE)
def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measurements of op3 and its base rule."""
    found = quality.verdicts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@query("shard_sizes", sql.SHARD_SIZES)
def shard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes and checksums of op7."""
    return shards.sharded(table(spark, sf_dir, "documents")).select("doc_id", "size", "text_crc32")
