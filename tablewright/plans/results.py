"""Queries: performance, comparison, significance, example selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.functions import text as tx
from tablewright.operators import overlap as ov
from tablewright.operators import reports as rp
from tablewright.operators import scores as sc
from tablewright.plans.registry import query
from tablewright.plans.text_metrics import MOST, MOST_METRICS
from tablewright.plans.views import (
    PREDICTIONS,
    REQUESTS,
    SPACE,
    predictions,
    requests,
    sql_repetition,
    sql_words,
    table,
)
from tablewright.session import fresh_folder
from tablewright.sources import writers as wr

Q = f"WITH {REQUESTS}"
MODELS = ["base", "finetuned"]

# --- performance -------------------------------------------------------------

MEASURED = """measured AS (SELECT * FROM requests QUALIFY row_number() OVER (PARTITION BY model, status ORDER BY ts, event_id) > 3)"""
PERF = "avg_latency_ms, avg_throughput_tokens_per_sec, avg_memory_mb, peak_memory_mb".split(", ")
PERF_SQL = """avg(latency_ms) AS avg_latency_ms, avg(tokens_generated) / (avg(latency_ms) / 1000) AS avg_throughput_tokens_per_sec,
    avg(memory_used_mb) AS avg_memory_mb, max(memory_used_mb) AS peak_memory_mb, count(*) AS runs"""


def _performance(spark, sf):
    return rp.performance_summary(requests(spark, sf), ["model", "status"], ["ts", "event_id"])


@query("performance_summary", f"{Q}, {MEASURED} SELECT model, status, {PERF_SQL} FROM measured GROUP BY ALL", doubles=PERF)
def performance_summary(spark, sf):
    return _performance(spark, sf)


POINTS = rp.LATENCY_POINTS


@query(
    "latency_percentiles",
    f"{Q} " + " UNION ALL ".join(
        f"SELECT model, CAST({p} AS DOUBLE) AS p, quantile_cont(latency_ms, {p / 100}) AS value FROM requests GROUP BY model" for p in POINTS
    ),
    doubles=["value"],
)
def latency_percentiles(spark, sf):
    return rp.latency_percentiles(requests(spark, sf), ["model"])


# --- metric rows: statistics of the events as metrics of two models ----------

METRIC_ROWS = f"""{REQUESTS}, rows AS (
  SELECT CASE event_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS dataset, * FROM requests),
metrics AS (
  SELECT dataset, model, 'mean_latency' AS metric, avg(latency_ms) AS value FROM rows GROUP BY ALL
  UNION ALL SELECT dataset, model, 'mean_tokens', avg(tokens_generated) FROM rows GROUP BY ALL
  UNION ALL SELECT dataset, model, 'error_rate', avg(CASE WHEN status = 'error' THEN 1.0 ELSE 0.0 END) FROM rows WHERE dataset <> 'a' OR model = 'base' GROUP BY ALL)"""


def _metrics(spark, sf):
    """One pass over the requests; ``error_rate`` is missing for one model of dataset a."""
    rows = requests(spark, sf).withColumn(
        "dataset", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("event_id") % 3 + 1).cast("int"))
    )
    means = rows.groupBy("dataset", "model").agg(
        F.avg("latency_ms").alias("mean_latency"),
        F.avg(F.col("tokens_generated").cast("double")).alias("mean_tokens"),
        F.avg((F.col("status") == "error").cast("double")).alias("error_rate"),
    )
    long = means.unpivot(["dataset", "model"], ["mean_latency", "mean_tokens", "error_rate"], "metric", "value")
    return long.filter("NOT (metric = 'error_rate' AND dataset = 'a' AND model = 'finetuned')")


def _shown(model: str) -> str:
    return f"coalesce(format('{{:.4f}}', max(CASE WHEN model = '{model}' THEN value END)), 'N/A') AS {model}"


@query(
    "comparison_table",
    f"WITH {METRIC_ROWS} SELECT dataset, metric, {_shown('base')}, {_shown('finetuned')} FROM metrics GROUP BY dataset, metric",
)
def comparison_table(spark, sf):
    return rp.comparison_table(_metrics(spark, sf), MODELS)


@query(
    "delta_table",
    f"""WITH {METRIC_ROWS} SELECT o.dataset, o.metric, o.model, b.value AS base_value, o.value, o.value - b.value AS absolute,
    100 * (o.value - b.value) / b.value AS relative_pct FROM metrics o JOIN metrics b
    ON b.dataset = o.dataset AND b.metric = o.metric AND b.model = 'base' WHERE o.model <> 'base'""",
    doubles=["base_value", "value", "absolute", "relative_pct"],
)
def delta_table(spark, sf):
    return rp.delta_table(_metrics(spark, sf), "base")


@query(
    "summary_rows",
    f"""WITH {METRIC_ROWS}, perf AS (SELECT model, dataset, {PERF_SQL} FROM rows GROUP BY ALL)
    SELECT model, dataset, metric, value FROM metrics UNION ALL
    SELECT model, dataset, 'perf_' || metric, value FROM (UNPIVOT (SELECT model, dataset, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in [*PERF, 'runs'])} FROM perf)
      ON {', '.join([*PERF, 'runs'])} INTO NAME metric VALUE value)""",
    doubles=["value"],
)
def summary_rows(spark, sf):
    rows = requests(spark, sf).withColumn(
        "dataset", F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("event_id") % 3 + 1).cast("int"))
    )
    perf = rp.performance_summary(rows, ["model", "dataset"], ["ts", "event_id"], warmup=0)
    return rp.summary_rows(_metrics(spark, sf), perf)


@query(
    "aggregate_runs",
    """SELECT event_type AS metric, avg(m) AS value, stddev_pop(m) AS std, min(m) AS min, max(m) AS max, count(*) AS runs
    FROM (SELECT user_id, event_type, avg(value) AS m FROM events GROUP BY ALL) GROUP BY event_type""",
    doubles=["value", "std", "min", "max"],
)
def aggregate_runs(spark, sf):
    per_run = table(spark, sf, "events").groupBy("user_id", F.col("event_type").alias("metric")).agg(F.avg("value").alias("value"))
    return rp.aggregate_runs(per_run)


@query(
    "category_rollup",
    """SELECT lang, source, sum(n_chars * w) / sum(w) AS weighted_mean, sum(w) AS weight, count(*) AS n,
    grouping(lang, source) AS level FROM (SELECT *, length(source) * 0.5 AS w FROM documents) GROUP BY ROLLUP (lang, source)""",
    doubles=["weighted_mean", "weight"],
)
def category_rollup(spark, sf):
    docs = table(spark, sf, "documents").withColumn("w", F.length("source") * F.lit(0.5))
    return rp.category_rollup(docs, ["lang", "source"], "n_chars", "w")


# --- significance ------------------------------------------------------------

GAP = f"""WITH {PREDICTIONS}, gaps AS (SELECT dataset, model, example_id, length(prediction) - length(reference) AS gap FROM predictions)"""


def _gaps(spark, sf):
    """Paired differences: an answer against the one before it in the conversation."""
    return predictions(spark, sf).select(
        "dataset", "model", "example_id", (F.length("prediction") - F.length("reference")).alias("gap")
    )


def _draw_sql(rows: str, samples: int) -> str:
    return f"""SELECT *, CAST('0x' || substr(md5('42:' || replicate || ':' || example_id), 1, 8) AS BIGINT) / 4294967296.0 AS u
      FROM (SELECT *, unnest(range(1, {samples + 1})) AS replicate FROM {rows})"""


TIMES = " + ".join(f"CASE WHEN u >= CAST({b!r} AS DOUBLE) THEN 1 ELSE 0 END" for b in rp.poisson_bounds())


@query(
    "bootstrap_ci",
    f"""{GAP}, drawn AS (SELECT *, {TIMES} AS k FROM ({_draw_sql('gaps', 1000)})),
    means AS (SELECT dataset, model, replicate, CAST(sum(k * gap) AS DOUBLE) / sum(k) AS m FROM drawn WHERE k > 0 GROUP BY ALL),
    bounds AS (SELECT dataset, model, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high, count(*) AS samples FROM means GROUP BY ALL)
    SELECT dataset, model, avg(gap) AS mean, any_value(low) AS low, any_value(high) AS high, any_value(samples) AS samples
    FROM gaps JOIN bounds USING (dataset, model) GROUP BY dataset, model""",
    doubles=["mean", "low", "high"],
)
def bootstrap_ci(spark, sf):
    return rp.bootstrap_ci(_gaps(spark, sf), "gap", "example_id", ["dataset", "model"])


@query(
    "permutation_test",
    f"""{GAP}, drawn AS ({_draw_sql('gaps', 1000)}),
    sums AS (SELECT model, replicate, avg(CASE WHEN u < 0.5 THEN gap ELSE -gap END) AS t, avg(gap) AS observed FROM drawn GROUP BY ALL)
    SELECT model, any_value(observed) AS mean_difference, (count(*) FILTER (abs(t) >= abs(observed) - 1e-12) + 1.0) / (count(*) + 1) AS p_value
    FROM sums GROUP BY model""",
    doubles=["mean_difference", "p_value"],
)
def permutation_test(spark, sf):
    return rp.permutation_test(_gaps(spark, sf), "gap", "example_id", ["model"])


WILCOXON = f"""{GAP}, ranked AS (SELECT *, rank() OVER (PARTITION BY model ORDER BY abs(gap)) + (count(*) OVER (PARTITION BY model, abs(gap)) - 1) / 2.0 AS r,
  count(*) OVER (PARTITION BY model, abs(gap)) AS t FROM gaps WHERE gap <> 0),
sums AS (SELECT model, CAST(count(*) AS DOUBLE) AS n, coalesce(sum(r) FILTER (gap > 0), 0) AS w_plus, coalesce(sum(r) FILTER (gap < 0), 0) AS w_minus,
  sum(CAST(t AS DOUBLE) * t - 1) AS ties FROM ranked GROUP BY model)"""


@query(
    "wilcoxon_signed_rank",
    f"""{WILCOXON} SELECT model, CAST(n AS BIGINT) AS n, w_plus, w_minus,
    (least(w_plus, w_minus) - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48) AS z FROM sums""",
    doubles=["w_plus", "w_minus", "z"],
)
def wilcoxon_signed_rank(spark, sf):
    return rp.wilcoxon_signed_rank(_gaps(spark, sf), "gap", ["model"]).drop("p_value")


@query(
    "bonferroni",
    """WITH tests AS (SELECT event_type, avg(CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END) AS p_value FROM events GROUP BY event_type)
    SELECT event_type, p_value, least(p_value * (SELECT count(*) FROM tests), 1.0) AS p_adjusted,
    least(p_value * (SELECT count(*) FROM tests), 1.0) < 0.05 AS significant FROM tests""",
    doubles=["p_value", "p_adjusted"],
)
def bonferroni(spark, sf):
    shares = table(spark, sf, "events").groupBy("event_type").agg(F.avg((F.col("value") > 100).cast("double")).alias("p_value"))
    return rp.bonferroni(shares)


# --- examples ----------------------------------------------------------------

SCORES = f"""WITH scored AS (SELECT doc_id, lang, text, ratio AS score FROM ({sql_repetition('documents', 'text', 'doc_id, lang, text', 1)}))"""


def _scores(spark, sf):
    """Share of repeated words as a score."""
    from tablewright.operators.validate import repetition_ratio

    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return docs.withColumn("score", repetition_ratio("text", 1))


def _pick(kind: str, order: str) -> str:
    return f"""SELECT lang, doc_id, score, '{kind}' AS kind, row_number() OVER (PARTITION BY lang ORDER BY {order}, doc_id) AS "rank" FROM centred QUALIFY "rank" <= 10"""


@query(
    "qualitative_examples",
    f"""{SCORES}, centred AS (SELECT s.*, m FROM scored s JOIN (SELECT lang, quantile_cont(score, 0.5) AS m FROM scored GROUP BY lang) USING (lang))
    SELECT lang, doc_id, score, kind, CAST("rank" AS INT) AS "rank" FROM (
      {_pick('best', 'score DESC')} UNION ALL {_pick('worst', 'score')} UNION ALL {_pick('median', 'abs(score - m)')})""",
    doubles=["score"],
)
def qualitative_examples(spark, sf):
    return rp.qualitative_examples(_scores(spark, sf).drop("text"), "score", "doc_id", ["lang"])


REFUSAL = rp.REFUSAL.replace("'", "''")


@query(
    "failure_analysis",
    f"""WITH graded AS (SELECT a.doc_id, a.text, b.ratio AS repeated, CAST(len({sql_words('a.text')}) AS DOUBLE) / 10 AS score FROM documents a
      JOIN ({sql_repetition('documents', 'text', 'doc_id')}) b USING (doc_id)),
    classed AS (SELECT doc_id, score, CASE WHEN NOT regexp_matches(text, '[^{SPACE}]') THEN 'empty' WHEN regexp_matches(text, '{REFUSAL}') THEN 'refusal'
      WHEN len({sql_words('text')}) < 3 THEN 'too_short' WHEN repeated > 0.5 THEN 'repeated' WHEN score < 0.4 THEN 'low_score' END AS error_class FROM graded)
    SELECT doc_id, score, error_class FROM classed WHERE error_class IS NOT NULL ORDER BY score, doc_id LIMIT 50""",
    doubles=["score"],
)
def failure_analysis(spark, sf):
    answers = table(spark, sf, "documents").select("doc_id", F.col("text").alias("prediction"))
    graded = answers.withColumn("score", tx.word_count("prediction") / 10)
    return rp.failure_analysis(graded, "score", "doc_id", low=0.4).drop("prediction")


@query(
    "score_distribution",
    f"{SCORES} SELECT lang, least(CAST(floor(score * 10) AS BIGINT) + 1, 10) AS bin, count(*) AS n FROM scored GROUP BY ALL",
)
def score_distribution(spark, sf):
    return rp.score_distribution(_scores(spark, sf), "score", ["lang"])


@query(
    "length_vs_score",
    f"{SCORES} SELECT lang, corr(CAST(len({sql_words('text')}) AS DOUBLE), score) AS correlation, count(*) AS n FROM scored GROUP BY lang",
    doubles=["correlation"],
)
def length_vs_score(spark, sf):
    return rp.length_vs_score(_scores(spark, sf), "text", "score", ["lang"])


CATEGORIES = ["accuracy", "clarity"]


@query(
    "judge_scores",
    """WITH replies AS (SELECT event_type, CASE WHEN k % 7 = 0 THEN NULL ELSE CAST(k % 10 AS DOUBLE) END AS accuracy,
      CASE WHEN k % 7 = 0 THEN NULL ELSE value END AS clarity
      FROM (SELECT event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)),
    long AS (SELECT event_type, 'accuracy' AS category, accuracy AS score FROM replies UNION ALL SELECT event_type, 'clarity', clarity FROM replies)
    SELECT event_type, category, avg(score) AS mean_score, count(score) AS n_scored, count(*) FILTER (score IS NULL) AS n_malformed
    FROM long GROUP BY ALL""",
    doubles=["mean_score"],
)
def judge_scores(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    reply = F.to_json(F.struct((k % 10).alias("accuracy"), F.col("value").alias("clarity")))
    replies = table(spark, sf, "events").select("event_type", F.when(k % 7 == 0, F.lit("not json {")).otherwise(reply).alias("reply"))
    return rp.judge_scores(replies, "reply", ["event_type"], CATEGORIES)


# --- evaluation report -------------------------------------------------------


@query("evaluation_report")
def evaluation_report(spark, sf):
    """Metrics of all models as a comparison table."""
    return rp.comparison_table(sc.calculate_all(predictions(spark, sf)), MODELS)


@query("evaluation_table", f"""WITH metrics AS ({MOST}) SELECT dataset, metric, {_shown('base')}, {_shown('finetuned')} FROM metrics GROUP BY dataset, metric""")
def evaluation_table(spark, sf):
    """The comparison table of the metrics that SQL can state."""
    return rp.comparison_table(sc.calculate_all(predictions(spark, sf), MOST_METRICS), MODELS)


REPORTED = f"WITH {METRIC_ROWS} SELECT model, dataset, metric, value FROM metrics"


@query("write_report_csv", REPORTED, doubles=["value"])
def write_report_csv(spark, sf):
    path = fresh_folder(spark, "report-csv")
    wr.write_report_csv(_metrics(spark, sf), path)
    return spark.read.option("header", True).schema("model string, dataset string, metric string, value double").csv(path)


@query("write_report_json", REPORTED, doubles=["value"])
def write_report_json(spark, sf):
    """Documents by model and dataset, read back and taken apart."""
    path = fresh_folder(spark, "report-json")
    wr.write_report_json(_metrics(spark, sf), path)
    found = spark.read.schema("model string, dataset string, metrics map<string,double>").json(path)
    return found.select("model", "dataset", F.explode("metrics").alias("metric", "value"))


@query(
    "write_report_markdown",
    f"""WITH {METRIC_ROWS}, rows_of AS (SELECT dataset, metric, {_shown('base')}, {_shown('finetuned')} FROM metrics GROUP BY dataset, metric),
    lines AS (SELECT dataset, 1 AS part, metric AS key, '| ' || metric || ' | ' || base || ' | ' || finetuned || ' |' AS line FROM rows_of
      UNION ALL SELECT DISTINCT dataset, 0, '', '## Dataset: ' || dataset || chr(10) || chr(10) || '| Metric | base | finetuned |' || chr(10) || '|---|---|---|' FROM rows_of)
    SELECT string_agg(line, chr(10) ORDER BY dataset, part, key) AS document FROM lines""",
)
def write_report_markdown(spark, sf):
    """The whole document, read back as one text."""
    path = fresh_folder(spark, "report-markdown")
    lines = rp.markdown_lines(rp.comparison_table(_metrics(spark, sf), MODELS), MODELS)
    text = "\n".join(r["line"] for r in lines.orderBy("dataset", "part", "key").collect())  # a line per dataset and metric
    wr.write_report_markdown(spark, text, path)
    return spark.read.text(path, wholetext=True).select(F.rtrim(F.regexp_replace("value", r"\n$", "")).alias("document"))


@query(
    "report_lines",
    f"""WITH {METRIC_ROWS}, lines AS (SELECT dataset, metric, {_shown('base')}, {_shown('finetuned')} FROM metrics GROUP BY dataset, metric)
    SELECT dataset, 1 AS part, metric AS key, '| ' || metric || ' | ' || base || ' | ' || finetuned || ' |' AS line FROM lines
    UNION ALL SELECT DISTINCT dataset, 0, '', '## Dataset: ' || dataset || chr(10) || chr(10) || '| Metric | base | finetuned |' || chr(10) || '|---|---|---|' FROM lines""",
)
def report_lines(spark, sf):
    return rp.markdown_lines(rp.comparison_table(_metrics(spark, sf), MODELS), MODELS)
