"""Tables derived from the given ones, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions import text as tx

SPACE = tx.SPACE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the answer in the next turn, and a system turn just before.

    Joined on (conversation, turn), which is unique, so a long conversation is spread.
    """
    turns = table(spark, sf_dir, "conversations")
    user = turns.filter("role = 'user'")
    answer = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    system = turns.filter("role = 'system'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("input")
    )
    return (
        user.join(answer, ["conv_id", "turn"])
        .join(system, ["conv_id", "turn"], "left")
        .select(
            (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("row_id"),
            F.concat(F.lit("set"), (F.col("conv_id") % 3).cast("string")).alias("dataset"),
            F.col("text").alias("instruction"),
            F.coalesce("input", F.lit("")).alias("input"),
            "output",
        )
    )


PAIRS = """pairs AS (
  SELECT u.conv_id * 1000000 + u.turn AS row_id, 'set' || CAST(u.conv_id % 3 AS VARCHAR) AS dataset,
         u.text AS instruction, coalesce(s.text, '') AS input, a.text AS output
  FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = u.turn - 1 AND s.role = 'system'
  WHERE u.role = 'user')"""


def doc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of a document as instruction, the rest as output."""
    docs = table(spark, sf_dir, "documents")
    cut = F.instr("text", "\n")
    return docs.select(
        F.col("doc_id").alias("row_id"),
        F.col("source").alias("dataset"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("instruction"),
        F.lit("").alias("input"),
        F.when(cut > 0, F.col("text").substr(cut + 1, F.length("text"))).alias("output"),
        "lang",
    )


DOC_RECORDS = """doc_records AS (
  SELECT doc_id AS row_id, source AS dataset, split_part(text, chr(10), 1) AS instruction, '' AS input,
         CASE WHEN instr(text, chr(10)) > 0 THEN substring(text, instr(text, chr(10)) + 1) END AS output, lang
  FROM documents)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers, with the previous and, where there is one, the next answer as references."""
    turns = table(spark, sf_dir, "conversations").filter("role = 'assistant'").drop("role")
    before = turns.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("text").alias("reference"))
    after = turns.select("conv_id", (F.col("turn") - 2).alias("turn"), F.col("text").alias("second"))
    refs = F.when(F.col("second").isNull(), F.array("reference")).otherwise(F.array("reference", "second"))
    return (
        turns.join(before, ["conv_id", "turn"])
        .join(after, ["conv_id", "turn"], "left")
        .select(
            (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("example_id"),
            F.when(F.col("conv_id") % 2 == 0, "base").otherwise("finetuned").alias("model"),
            F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("conv_id") % 3 + 1).cast("int")).alias("dataset"),
            F.col("text").alias("prediction"),
            "reference",
            refs.alias("references"),
        )
    )


PREDICTIONS = """predictions AS (
  SELECT p.conv_id * 1000000 + p.turn AS example_id,
         CASE WHEN p.conv_id % 2 = 0 THEN 'base' ELSE 'finetuned' END AS model,
         CASE p.conv_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS dataset,
         p.text AS prediction, r.text AS reference,
         CASE WHEN s.text IS NULL THEN [r.text] ELSE [r.text, s.text] END AS refs
  FROM conversations p
  JOIN conversations r ON r.conv_id = p.conv_id AND r.turn = p.turn - 2 AND r.role = 'assistant'
  LEFT JOIN conversations s ON s.conv_id = p.conv_id AND s.turn = p.turn + 2 AND s.role = 'assistant'
  WHERE p.role = 'assistant')"""


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.col("event_id").alias("step"), "ts", F.col("event_type").alias("metric"), "value"
    )


METRIC_LOG = """metric_log AS (
  SELECT user_id AS run, event_id AS step, ts, event_type AS metric, value FROM events)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_columns(table(spark, sf_dir, "events"))


def request_columns(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "event_id",
        "user_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("user_id") % 2 == 0, "base").otherwise("finetuned").alias("model"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        F.col("value").alias("latency_ms"),
        k.alias("tokens_generated"),
        (k * 10.0 + 500).alias("memory_used_mb"),
    )


REQUESTS = """requests AS (
  SELECT event_id, user_id, ts, CASE WHEN user_id % 2 = 0 THEN 'base' ELSE 'finetuned' END AS model,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status, value AS latency_ms,
         CAST(json_extract_string(props, '$.k') AS INT) AS tokens_generated,
         CAST(json_extract_string(props, '$.k') AS INT) * 10.0 + 500 AS memory_used_mb
  FROM events)"""


# --- SQL fragments -----------------------------------------------------------


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def sql_words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{SPACE}]+')"


def sql_alnum(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z0-9]+')"


def sql_grams(tokens: str, n: int, joiner: str = "chr(31)") -> str:
    if n == 1:
        return tokens
    return (
        f"list_transform(range(1, CAST(len({tokens}) AS BIGINT) - {n - 2}), "
        f"lambda i: array_to_string({tokens}[i:i + {n - 1}], {joiner}))"
    )


def sql_key(seed: int, row_id: str) -> str:
    return f"md5('{seed}:' || CAST({row_id} AS VARCHAR))"


def sql_unit(key: str) -> str:
    return f"(CAST('0x' || substr({key}, 1, 8) AS BIGINT) / 4294967296.0)"


def sql_repetition(source: str, text: str, columns: str, n: int = 4) -> str:
    return f"""SELECT {columns}, CASE WHEN len(g) > 0 THEN 1 - CAST(len(list_distinct(g)) AS DOUBLE) / len(g) ELSE 0.0 END AS ratio
      FROM (SELECT {columns}, {sql_grams('w', n)} AS g FROM (SELECT {columns}, {sql_words(text)} AS w FROM {source}))"""
