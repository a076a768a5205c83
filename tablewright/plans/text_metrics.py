"""Queries: overlap, alignment, diversity, perplexity and embedding metrics."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tablewright.functions import alignment as al
from tablewright.functions import text as tx
from tablewright.operators import overlap as ov
from tablewright.operators import scores as sc
from tablewright.operators.blocks import block_table
from tablewright.plans.registry import SQL, query
from tablewright.plans.views import (
    PREDICTIONS,
    SPACE,
    predictions,
    sql_alnum,
    sql_grams,
    sql_words,
    table,
)

R = f"WITH {PREDICTIONS}"
K = "dataset, model, example_id"

# --- SQL building blocks -----------------------------------------------------


def _counts(tokens: str, orders: range, joiner: str = "chr(31)") -> str:
    """Clipped counts per example and order from CTE ``tok(keys, side, w)``."""
    grams = " UNION ALL ".join(
        f"SELECT {K}, side, {n} AS n, unnest({sql_grams('w', n, joiner)}) AS gram FROM {tokens}" for n in orders
    )
    return f"""grams AS ({grams}),
    per_side AS (SELECT {K}, side, n, gram, count(*) AS c FROM grams GROUP BY ALL),
    clipped AS (SELECT {K}, n, gram, coalesce(sum(c) FILTER (side = 0), 0) AS p, coalesce(max(c) FILTER (side > 0), 0) AS r
      FROM per_side GROUP BY ALL),
    orders AS (SELECT e.dataset, e.model, e.example_id, o.n, coalesce(sum(least(p, r)), 0) AS m, coalesce(sum(p), 0) AS p, coalesce(sum(r), 0) AS r
      FROM (SELECT DISTINCT {K} FROM {tokens}) e CROSS JOIN (SELECT unnest(range({orders.start}, {orders.stop})) AS n) o
      LEFT JOIN clipped c ON c.dataset = e.dataset AND c.model = e.model AND c.example_id = e.example_id AND c.n = o.n GROUP BY ALL)"""


def _sides(words, references: str = "[reference]") -> str:
    return f"""tok AS (
      SELECT {K}, 0 AS side, {words('prediction')} AS w FROM predictions
      UNION ALL SELECT {K}, side, {words('ref')} FROM (
        SELECT {K}, unnest({references}) AS ref, unnest(range(1, CAST(len({references}) AS BIGINT) + 1)) AS side FROM predictions))"""


F1 = "CASE WHEN m > 0 THEN 2.0 * m / (p + r) ELSE 0.0 END"
ROUGE = f"""{R}, {_sides(sql_alnum)}, {_counts('tok', range(1, 3))}"""


@query(
    "rouge_n",
    f"""{ROUGE} SELECT {K}, max(CASE WHEN n = 1 THEN {F1} END) AS rouge1, max(CASE WHEN n = 2 THEN {F1} END) AS rouge2
    FROM orders GROUP BY ALL""",
    doubles=["rouge1", "rouge2"],
)
def rouge_n(spark, sf):
    return ov.rouge_n(predictions(spark, sf))


@query(
    "rouge_n_summary",
    f"""{ROUGE} SELECT dataset, model, 'rouge' || n AS metric, avg(f) AS value, stddev_pop(f) AS std, min(f) AS min, max(f) AS max, count(*) AS n
    FROM (SELECT *, {F1} AS f FROM orders) GROUP BY dataset, model, n""",
    doubles=["value", "std", "min", "max"],
)
def rouge_n_summary(spark, sf):
    return ov.summarize(ov.rouge_n(predictions(spark, sf)), ["rouge1", "rouge2"])


@query("rouge_n_stemmed")
def rouge_n_stemmed(spark, sf):
    return ov.rouge_n(predictions(spark, sf), stem=True)


@query("stem_tokens")
def stem_tokens(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.array_join(al.stem_words(tx.alnum_words("text")), " ").alias("stems"))


def _grid(words, shape, start: str, cell: str, row: str) -> str:
    """Dynamic programming over the words of prediction (i) and reference (j), a row of cells at a time."""
    return f"""WITH RECURSIVE {PREDICTIONS},
    sides AS (SELECT row_number() OVER () AS pair, {K}, {words(shape('prediction'))} AS a, {words(shape('reference'))} AS b FROM predictions),
    own AS (SELECT pair, unnest(a) AS x, unnest(range(1, CAST(len(a) AS BIGINT) + 1)) AS i FROM sides),
    other AS (SELECT pair, CAST(NULL AS VARCHAR) AS y, 0 AS j FROM sides UNION ALL SELECT pair, unnest(b), unnest(range(1, CAST(len(b) AS BIGINT) + 1)) FROM sides),
    steps(pair, i, j, v) AS (
      SELECT pair, CAST(0 AS BIGINT), CAST(j AS BIGINT), CAST({start} AS BIGINT) FROM other
      UNION ALL SELECT pair, i, j, CAST({row} AS BIGINT) FROM (
        SELECT s.pair, o.i, s.j, {cell} AS t FROM steps s JOIN own o ON o.pair = s.pair AND o.i = s.i + 1 JOIN other t ON t.pair = s.pair AND t.j = s.j)),
    ends AS (SELECT s.dataset, s.model, s.example_id, len(s.a) AS n, len(s.b) AS m, v FROM sides s JOIN steps e ON e.pair = s.pair AND e.i = len(s.a) AND e.j = len(s.b))"""


_BEFORE = "lag(s.v) OVER (PARTITION BY s.pair ORDER BY s.j)"
LCS = _grid(sql_alnum, str, "0", f"CASE WHEN o.x = t.y THEN {_BEFORE} + 1 ELSE s.v END", "max(t) OVER (PARTITION BY pair ORDER BY j)")
EDITS = _grid(
    sql_words, lambda c: f"lower({c})", "j",
    f"CASE WHEN s.j = 0 THEN o.i ELSE least(s.v + 1, {_BEFORE} + CASE WHEN o.x = t.y THEN 0 ELSE 1 END) END",
    "j + min(t - j) OVER (PARTITION BY pair ORDER BY j)",
)


@query("rouge_l")
def rouge_l(spark, sf):
    return sc.rouge_l(predictions(spark, sf))


@query("rouge_l_words", f"{LCS} SELECT {K}, CASE WHEN v > 0 THEN 2.0 * v / (n + m) ELSE 0.0 END AS \"rougeL\" FROM ends", doubles=["rougeL"])
def rouge_l_words(spark, sf):
    """The part of ``rouge_l`` that SQL can state."""
    return sc.rouge_l(predictions(spark, sf)).drop("rougeLsum")


# --- BLEU --------------------------------------------------------------------

BLEU = f"""{R}, {_sides(sql_words, 'refs')}, {_counts('tok', range(1, 5))},
sizes AS (SELECT {K}, max(len(w)) FILTER (side = 0) AS h FROM tok GROUP BY ALL),
closest AS (SELECT t.dataset, t.model, t.example_id, any_value(h) AS h, arg_min(len(w), abs(len(w) - h) * 1000000 + len(w)) AS l
  FROM tok t JOIN sizes s ON s.dataset = t.dataset AND s.model = t.model AND s.example_id = t.example_id WHERE side > 0 GROUP BY ALL),
stats AS (SELECT o.dataset, o.model, o.example_id, h, l, o.n, m, greatest(p, 1) AS t FROM orders o
  JOIN closest c ON c.dataset = o.dataset AND c.model = o.model AND c.example_id = o.example_id)"""


def _precision(smoothing: str) -> str:
    if smoothing == "exp":
        return "CASE WHEN m = 0 THEN CAST(0.1 AS DOUBLE) / t ELSE CAST(m AS DOUBLE) / t END"
    if smoothing == "floor":
        return "CASE WHEN n = 1 THEN CAST(m AS DOUBLE) / t ELSE CAST(m + 1 AS DOUBLE) / (t + 1) END"
    return "CASE WHEN m = 0 THEN 1.0 / (pow(2.0, z) * t) ELSE CAST(m AS DOUBLE) / t END"


def _bleu(source: str, keys: str, smoothing: str) -> str:
    """Score from rows (keys, n, m, t, h, l), z counting the zero orders so far."""
    return f"""SELECT {keys}, CASE WHEN max(CASE WHEN n = 1 THEN m END) = 0 THEN 0.0 ELSE
      CASE WHEN any_value(h) > any_value(l) THEN 1.0 WHEN any_value(h) = 0 THEN 0.0
        ELSE exp(1 - CAST(any_value(l) AS DOUBLE) / any_value(h)) END
      * exp(sum(CASE WHEN m + t > 0 THEN ln(greatest({_precision(smoothing)}, 1e-300)) / 4.0 END)) END AS bleu
      FROM (SELECT *, sum(CASE WHEN m = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY n) AS z FROM {source}) GROUP BY {keys}"""


def _corpus(smoothing: str) -> str:
    return f"""{BLEU}, summed AS (SELECT dataset, model, n, sum(m) AS m, sum(t) AS t, sum(h) AS h, sum(l) AS l FROM stats GROUP BY ALL),
    whole AS ({_bleu('summed', 'dataset, model', smoothing)}), single AS ({_bleu('stats', K, smoothing)}),
    spread AS (SELECT dataset, model, avg(bleu) AS sentence_bleu_mean, stddev_pop(bleu) AS sentence_bleu_std, count(*) AS n FROM single GROUP BY ALL)
    SELECT dataset, model, bleu, sentence_bleu_mean, sentence_bleu_std, n FROM whole JOIN spread USING (dataset, model)"""


def _corpus_bleu(smoothing: str):
    return lambda spark, sf: ov.corpus_bleu(ov.bleu_stats(predictions(spark, sf)), smoothing=smoothing)


for _name, _smoothing in (("corpus_bleu", "exp"), ("corpus_bleu_floor", "floor"), ("corpus_bleu_add_k", "add-k")):
    query(_name, _corpus(_smoothing), doubles=["bleu", "sentence_bleu_mean", "sentence_bleu_std"])(_corpus_bleu(_smoothing))


@query("sentence_bleu", f"{BLEU} SELECT {K}, bleu AS sentence_bleu FROM ({_bleu('stats', K, 'exp')})", doubles=["sentence_bleu"])
def sentence_bleu(spark, sf):
    return ov.sentence_bleu(ov.bleu_stats(predictions(spark, sf))).select("dataset", "model", "example_id", "sentence_bleu")


@query("meteor")
def meteor(spark, sf):
    return sc.meteor(predictions(spark, sf))


# --- diversity ---------------------------------------------------------------


def _distinct_sql(source: str, text: str, by: str) -> str:
    grams = " UNION ALL ".join(f"SELECT {by}, {n} AS n, unnest({sql_grams('w', n)}) AS gram FROM words" for n in range(1, 5))
    return f"""words AS (SELECT {by}, {sql_words(text)} AS w FROM {source}), grams AS ({grams}),
    counted AS (SELECT {by}, n, gram, count(*) AS c FROM grams GROUP BY ALL)
    SELECT {by}, CAST(n AS INT) AS n, count(*) AS unique_ngrams, CAST(sum(c) AS BIGINT) AS total_ngrams,
    CAST(count(*) AS DOUBLE) / sum(c) AS "distinct" FROM counted GROUP BY {by}, n"""


@query("distinct_n", f"WITH {_distinct_sql('documents', 'text', 'lang')}", doubles=[])
def distinct_n(spark, sf):
    return ov.distinct_n(table(spark, sf, "documents"), "text", by=["lang"])


@query("distinct_n_predictions", f"{R}, {_distinct_sql('predictions', 'prediction', 'dataset, model')}")
def distinct_n_predictions(spark, sf):
    return ov.distinct_n(predictions(spark, sf), "prediction")


SELF_BLEU = f"""{R}, words AS (SELECT dataset, model, example_id, {sql_words('prediction')} AS w FROM predictions),
grams AS ({" UNION ALL ".join(f"SELECT {K}, {n} AS n, unnest({sql_grams('w', n)}) AS gram FROM words" for n in range(1, 5))}),
counts AS (SELECT {K}, n, gram, count(*) AS c FROM grams GROUP BY ALL),
others AS (SELECT a.dataset, a.model, a.example_id, a.n, a.gram, any_value(a.c) AS c, coalesce(max(b.c), 0) AS best
  FROM counts a LEFT JOIN counts b ON b.dataset = a.dataset AND b.model = a.model AND b.n = a.n AND b.gram = a.gram AND b.example_id <> a.example_id
  GROUP BY ALL),
matched AS (SELECT {K}, n, sum(least(c, best)) AS m, sum(c) AS t FROM others GROUP BY ALL),
closest AS (SELECT a.dataset, a.model, a.example_id, any_value(len(a.w)) AS h,
  arg_min(len(b.w), abs(len(a.w) - len(b.w)) * 1000000 + len(b.w)) AS l
  FROM words a JOIN words b ON b.dataset = a.dataset AND b.model = a.model AND b.example_id <> a.example_id GROUP BY ALL),
stats AS (SELECT c.dataset, c.model, c.example_id, h, l, o.n, coalesce(m, 0) AS m, greatest(coalesce(t, 0), 1) AS t
  FROM closest c CROSS JOIN (SELECT unnest(range(1, 5)) AS n) o
  LEFT JOIN matched x ON x.dataset = c.dataset AND x.model = c.model AND x.example_id = c.example_id AND x.n = o.n)"""


@query(
    "self_bleu",
    f"{SELF_BLEU} SELECT dataset, model, avg(bleu) AS self_bleu, count(*) AS n FROM ({_bleu('stats', K, 'exp')}) GROUP BY ALL",
    doubles=["self_bleu"],
)
def self_bleu(spark, sf):
    return ov.self_bleu(predictions(spark, sf), "prediction", "example_id")


# --- character and answer scores ---------------------------------------------

MARK = "[!-/:-@\\[-`{-~]"


def _marks(t: str) -> str:
    """Words with one edge punctuation mark split off."""
    return f"""flatten(list_transform({sql_words(t)}, lambda t: CASE WHEN length(t) = 1 THEN [t]
      WHEN regexp_matches(t, '{MARK}$') THEN [t[1:length(t) - 1], t[length(t):length(t)]]
      WHEN regexp_matches(t, '^{MARK}') THEN [t[1:1], t[2:length(t)]] ELSE [t] END))"""


def _chars(t: str) -> str:
    return f"regexp_extract_all({t}, '[^{SPACE}]')"


def _order_sums(name: str, words, orders: range, joiner: str, shift: int) -> str:
    return f"""{name} AS (WITH {_sides(words)}, {_counts('tok', orders, joiner)}
      SELECT dataset, model, n + {shift} AS n, sum(m) AS m, sum(p) AS p, sum(r) AS r FROM orders GROUP BY ALL)"""


@query(
    "chrf",
    f"""{R}, {_order_sums('chars', _chars, range(1, 7), "''", 0)}, {_order_sums('marks', _marks, range(1, 3), 'chr(31)', 6)},
    means AS (SELECT dataset, model, avg(CAST(m AS DOUBLE) / p) AS p, avg(CAST(m AS DOUBLE) / r) AS r
      FROM (SELECT * FROM chars UNION ALL SELECT * FROM marks) WHERE p > 0 AND r > 0 GROUP BY ALL)
    SELECT dataset, model, 100 * CASE WHEN p + r > 0 THEN 5 * p * r / (4 * p + r) ELSE 0 END AS chrf FROM means""",
    doubles=["chrf"],
)
def chrf(spark, sf):
    return ov.chrf(predictions(spark, sf))


def _answer(c: str) -> str:
    squeezed = f"regexp_replace(regexp_replace(lower({c}), '{MARK}', '', 'g'), '[{SPACE}]+', ' ', 'g')"
    return f"trim({squeezed})"


@query(
    "exact_match",
    f"""WITH words AS (SELECT a.source AS dataset, a.lang AS model, string_split(a.text, ' ') AS p, string_split(b.text, ' ') AS r
      FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
    answers AS (SELECT dataset, model, unnest(p[1:least(len(p), len(r))]) AS prediction, unnest(r[1:least(len(p), len(r))]) AS reference FROM words)
    SELECT dataset, model, avg(CASE WHEN {_answer('prediction')} = {_answer('reference')} THEN 1.0 ELSE 0.0 END) AS exact_match, count(*) AS n
    FROM answers GROUP BY ALL""",
    doubles=["exact_match"],
)
def exact_match(spark, sf):
    """Each word of a document against the word at its place in the next document."""
    docs = table(spark, sf, "documents")
    following = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.split("text", " ").alias("r"))
    both = docs.select("doc_id", F.col("source").alias("dataset"), F.col("lang").alias("model"), F.split("text", " ").alias("p")).join(following, "doc_id")
    words = F.zip_with("p", "r", lambda p, r: F.struct(p.alias("prediction"), r.alias("reference")))
    answers = both.select("dataset", "model", F.inline(words)).filter("prediction IS NOT NULL AND reference IS NOT NULL")
    return ov.exact_match(answers)


def _answer_words(c: str) -> str:
    return sql_words(_answer(c))


@query(
    "f1_token",
    f"""{R}, {_sides(_answer_words)}, {_counts('tok', range(1, 2))}
    SELECT dataset, model, CAST(sum(m) AS DOUBLE) / sum(p) AS precision, CAST(sum(m) AS DOUBLE) / sum(r) AS recall,
    2.0 * sum(m) / (sum(p) + sum(r)) AS f1 FROM orders GROUP BY dataset, model""",
    doubles=["precision", "recall", "f1"],
)
def f1_token(spark, sf):
    return ov.f1_token(predictions(spark, sf))


@query(
    "ter",
    f"""{EDITS} SELECT dataset, model, CAST(sum(v) AS BIGINT) AS edits, CAST(sum(m) AS BIGINT) AS ref_words,
    CASE WHEN sum(m) > 0 THEN CAST(sum(v) AS DOUBLE) / sum(m) ELSE 0.0 END AS ter FROM ends GROUP BY dataset, model""",
    doubles=["ter"],
)
def ter(spark, sf):
    return sc.ter(predictions(spark, sf))


@query(
    "pass_at_k",
    """WITH problems AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type IN ('click', 'view')) AS c FROM events GROUP BY user_id),
    long AS (SELECT *, unnest([1, 5, 10, 100]) AS k FROM problems)
    SELECT k, avg(CASE WHEN c = 0 THEN 0.0 WHEN n - c < k THEN 1.0
      ELSE 1 - list_product(list_transform(range(n - c + 1, n + 1), lambda i: 1 - CAST(k AS DOUBLE) / i)) END) AS pass_at_k,
    count(*) AS problems FROM long WHERE n >= k GROUP BY k""",
    doubles=["pass_at_k"],
)
def pass_at_k(spark, sf):
    outcomes = table(spark, sf, "events").withColumn("passed", F.col("event_type").isin("click", "view"))
    return sc.pass_at_k(outcomes, [1, 5, 10, 100], ["user_id"], "passed")


@query(
    "perplexity",
    """SELECT event_type, sum(value / 100 * k) FILTER (k >= 2) AS total_loss, CAST(sum(k) FILTER (k >= 2) AS BIGINT) AS total_tokens,
    exp(sum(value / 100 * k) FILTER (k >= 2) / sum(k) FILTER (k >= 2)) AS perplexity
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) GROUP BY event_type""",
    doubles=["total_loss", "perplexity"],
)
def perplexity(spark, sf):
    chunks = table(spark, sf, "events").select(
        "event_type", (F.col("value") / 100).alias("loss"), F.get_json_object("props", "$.k").cast("int").alias("n_tokens")
    )
    return sc.perplexity(chunks, by=["event_type"])


# --- bigram model ------------------------------------------------------------

BIGRAMS = f"""words AS (SELECT doc_id, {sql_words('text')} AS w FROM documents),
pairs AS (SELECT doc_id, unnest(w[1:len(w) - 1]) AS prev, unnest(w[2:len(w)]) AS word FROM words WHERE len(w) > 1),
model AS (SELECT prev, word, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY prev) AS BIGINT) AS n_prev FROM pairs GROUP BY prev, word)"""
LM_SCORES = f"""{BIGRAMS}, size AS (SELECT count(DISTINCT t) AS v FROM (SELECT unnest(w) AS t FROM words)),
scored AS (SELECT doc_id, exp(-avg(ln((n + 1.0) / (n_prev + 1.0 * v)))) AS perplexity, count(*) AS n_bigrams
  FROM pairs JOIN model USING (prev, word), size GROUP BY doc_id)"""


@query("ngram_lm_fit", f"WITH {BIGRAMS} SELECT prev, word, n, n_prev FROM model")
def ngram_lm_fit(spark, sf):
    return sc.ngram_lm_fit(table(spark, sf, "documents"), "text")


def _lm_scores(spark, sf):
    docs = table(spark, sf, "documents")
    with block_table(docs, ["doc_id"], "text") as tokens:
        model, size = sc.ngram_lm_fit(docs, "text", tokens), sc.vocabulary_size(docs, "text", tokens)
        return sc.ngram_lm_score(docs, "text", model, size, "doc_id", tokens=tokens)


@query("ngram_lm_score", f"WITH {LM_SCORES} SELECT * FROM scored", doubles=["perplexity"], digits=4)
def ngram_lm_score(spark, sf):
    return _lm_scores(spark, sf)


@query(
    "perplexity_filter",
    f"WITH {LM_SCORES} SELECT doc_id, source FROM documents LEFT JOIN scored USING (doc_id) WHERE perplexity IS NULL OR perplexity <= 20000",
)
def perplexity_filter(spark, sf):
    docs = table(spark, sf, "documents")
    return sc.perplexity_filter(docs, _lm_scores(spark, sf), 20_000, "doc_id").select("doc_id", "source")


# --- embeddings --------------------------------------------------------------

METRICS = {
    "cosine": "list_cosine_similarity(a, b)",
    "dot": "list_inner_product(a, b)",
    "euclidean": "list_distance(a, b)",
    "manhattan": "list_sum(list_transform(list_zip(a, b), lambda x: abs(x[1] - x[2])))",
}


@query(
    "cosine_similarity",
    "SELECT vec_id, label, " + ", ".join(f"{e} AS {m}" for m, e in METRICS.items()) + """ FROM (
      SELECT x.vec_id, x.label, CAST(x.embedding AS DOUBLE[]) AS a, CAST(y.embedding AS DOUBLE[]) AS b
      FROM embeddings x JOIN embeddings y ON y.vec_id = x.vec_id + 1)""",
    doubles=list(METRICS),
)
def cosine_similarity(spark, sf):
    rows = table(spark, sf, "embeddings")
    following = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    both = rows.join(following, "vec_id")
    return both.select("vec_id", "label", *[sc.similarity("embedding", "b", m).alias(m) for m in METRICS])


@query(
    "bertscore",
    """WITH v AS (SELECT vec_id // 10 AS example_id, vec_id % 10 < 5 AS predicted, CAST(embedding AS DOUBLE[]) AS e, vec_id FROM embeddings),
    cos AS (SELECT a.example_id, a.vec_id AS p, b.vec_id AS r, list_cosine_similarity(a.e, b.e) AS s
      FROM v a JOIN v b ON b.example_id = a.example_id WHERE a.predicted AND NOT b.predicted),
    pr AS (SELECT example_id, avg(s) AS precision FROM (SELECT example_id, p, max(s) AS s FROM cos GROUP BY ALL) GROUP BY example_id),
    re AS (SELECT example_id, avg(s) AS recall FROM (SELECT example_id, r, max(s) AS s FROM cos GROUP BY ALL) GROUP BY example_id)
    SELECT example_id, precision AS bertscore_precision, recall AS bertscore_recall, 2 * precision * recall / (precision + recall) AS bertscore_f1
    FROM pr JOIN re USING (example_id)""",
    doubles=["bertscore_precision", "bertscore_recall", "bertscore_f1"],
)
def bertscore(spark, sf):
    # five token vectors on each side of an example
    mine = F.col("vec_id") % 10 < 5
    rows = table(spark, sf, "embeddings").groupBy(F.floor(F.col("vec_id") / 10).alias("example_id")).agg(
        F.collect_list(F.when(mine, F.col("embedding"))).alias("predicted"),
        F.collect_list(F.when(~mine, F.col("embedding"))).alias("reference"),
    )
    return sc.bertscore(rows, "predicted", "reference", ["example_id"])


def _token_vectors(spark, sf):
    """Ten token vectors of an example, five on each side; the label stands for the token."""
    return table(spark, sf, "embeddings").select(
        F.floor(F.col("vec_id") / 10).alias("example_id"),
        F.when(F.floor(F.col("vec_id") / 10) % 2 == 0, "base").otherwise("finetuned").alias("model"),
        (F.col("vec_id") % 10 < 5).alias("predicted"),
        (F.col("vec_id") % 5).alias("position"),
        F.col("label").cast("string").alias("token"),
        F.col("embedding").alias("vector"),
    )


IDF_SCORES = """v AS (SELECT vec_id // 10 AS example_id, CASE WHEN vec_id // 10 % 2 = 0 THEN 'base' ELSE 'finetuned' END AS model, vec_id % 10 < 5 AS predicted,
    CAST(label AS VARCHAR) AS token, CAST(embedding AS DOUBLE[]) AS e, vec_id FROM embeddings),
  documents_of AS (SELECT count(DISTINCT example_id) AS m FROM v WHERE NOT predicted),
  frequency AS (SELECT token, ln((any_value(m) + 1) / (count(DISTINCT example_id) + 1)) AS idf FROM v, documents_of WHERE NOT predicted GROUP BY token),
  weighed AS (SELECT v.*, coalesce(idf, ln(m + 1)) AS w FROM v CROSS JOIN documents_of LEFT JOIN frequency USING (token)),
  cos AS (SELECT a.example_id, a.model, a.vec_id AS p, b.vec_id AS r, a.w AS pw, b.w AS rw, list_cosine_similarity(a.e, b.e) AS s
    FROM weighed a JOIN weighed b ON b.example_id = a.example_id WHERE a.predicted AND NOT b.predicted),
  pr AS (SELECT example_id, model, CASE WHEN sum(w) <> 0 THEN sum(s * w) / sum(w) ELSE 0 END AS "precision" FROM (SELECT example_id, model, p, any_value(pw) AS w, max(s) AS s FROM cos GROUP BY ALL) GROUP BY ALL),
  re AS (SELECT example_id, CASE WHEN sum(w) <> 0 THEN sum(s * w) / sum(w) ELSE 0 END AS recall FROM (SELECT example_id, r, any_value(rw) AS w, max(s) AS s FROM cos GROUP BY ALL) GROUP BY ALL),
  scored AS (SELECT model, example_id, "precision" AS bertscore_precision, recall AS bertscore_recall,
    CASE WHEN "precision" + recall <> 0 THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0.0 END AS bertscore_f1 FROM pr JOIN re USING (example_id))"""


@query("bertscore_idf", f"WITH {IDF_SCORES} SELECT * FROM scored", doubles=["bertscore_precision", "bertscore_recall", "bertscore_f1"])
def bertscore_idf(spark, sf):
    return sc.idf_bertscore(_token_vectors(spark, sf), ["model", "example_id"])


@query(
    "bertscore_summary",
    f"""WITH {IDF_SCORES}, long AS (SELECT model, 'bertscore_precision' AS metric, bertscore_precision AS v FROM scored
      UNION ALL SELECT model, 'bertscore_recall', bertscore_recall FROM scored UNION ALL SELECT model, 'bertscore_f1', bertscore_f1 FROM scored)
    SELECT model, metric, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, max(v) AS max, count(v) AS n FROM long GROUP BY model, metric""",
    doubles=["mean", "std", "min", "max"],
)
def bertscore_summary(spark, sf):
    scores = sc.idf_bertscore(_token_vectors(spark, sf), ["model", "example_id"])
    return sc.score_summary(scores, ["bertscore_precision", "bertscore_recall", "bertscore_f1"], ["model"])


# --- collections -------------------------------------------------------------


@query("calculate_all")
def calculate_all(spark, sf):
    return sc.calculate_all(predictions(spark, sf))


@query(
    "calculate_overlap_metrics",
    f"""{_corpus('exp').split('SELECT dataset, model, bleu, sentence_bleu_mean')[0]},
    exact AS (SELECT dataset, model, avg(CASE WHEN {_answer('prediction')} = {_answer('reference')} THEN 1.0 ELSE 0.0 END) AS value FROM predictions GROUP BY ALL)
    SELECT dataset, model, 'bleu' AS metric, bleu AS value FROM whole
    UNION ALL SELECT dataset, model, 'exact_match', value FROM exact""",
    doubles=["value"],
)
def calculate_overlap_metrics(spark, sf):
    return sc.calculate_all(predictions(spark, sf), ["bleu", "exact_match"])


MOST_METRICS = ["bleu", "distinct", "chrf", "f1", "ter", "self_bleu"]
MOST = f"""SELECT dataset, model, 'bleu' AS metric, bleu AS value FROM ({SQL["corpus_bleu"]})
  UNION ALL SELECT dataset, model, 'distinct_' || n, "distinct" FROM ({SQL["distinct_n_predictions"]})
  UNION ALL SELECT dataset, model, 'chrf', chrf FROM ({SQL["chrf"]})
  UNION ALL SELECT dataset, model, 'f1', f1 FROM ({SQL["f1_token"]})
  UNION ALL SELECT dataset, model, 'ter', ter FROM ({SQL["ter"]})
  UNION ALL SELECT dataset, model, 'self_bleu', self_bleu FROM ({SQL["self_bleu"]})"""


@query("calculate_most", MOST, doubles=["value"])
def calculate_most(spark, sf):
    """The collection without ROUGE-Lsum and METEOR, which SQL can't state."""
    return sc.calculate_all(predictions(spark, sf), MOST_METRICS)


#: the correlation of the lengths of prediction and reference, from six sums
LENGTH_CORRELATION = sc.Fold(
    ("prediction", "reference"),
    lambda: [0.0] * 6,
    lambda state, batch: [a + float(b) for a, b in zip(state, _length_sums(batch["prediction"].str.len(), batch["reference"].str.len()))],
    lambda x, y: [a + b for a, b in zip(x, y)],
    lambda s: (s[0] * s[3] - s[1] * s[2]) / math.sqrt((s[0] * s[4] - s[1] ** 2) * (s[0] * s[5] - s[2] ** 2)),
)


def _length_sums(x, y):
    x, y = x.astype("float64"), y.astype("float64")
    return len(x), x.sum(), y.sum(), (x * y).sum(), (x * x).sum(), (y * y).sum()


@query(
    "fold_metric",
    f"{R} SELECT dataset, model, 'length_correlation' AS metric, corr(length(prediction), length(reference)) AS value FROM predictions GROUP BY dataset, model",
    doubles=["value"],
)
def fold_metric(spark, sf):
    sc.fold_metric("length_correlation", LENGTH_CORRELATION)
    return sc.calculate_all(predictions(spark, sf), [], ["length_correlation"])


@query(
    "best_and_worst",
    f"""{R}, vals AS (SELECT dataset, model, 'length_gap' AS metric, avg(abs(length(prediction) - length(reference))) AS value, -1 AS up FROM predictions GROUP BY dataset, model
      UNION ALL SELECT dataset, model, 'length_correlation', corr(length(prediction), length(reference)), 1 FROM predictions GROUP BY dataset, model)
    SELECT dataset, metric, first(model ORDER BY value * up DESC, model) AS best_model, first(value ORDER BY value * up DESC, model) AS best_value,
      first(model ORDER BY value * up, model) AS worst_model, first(value ORDER BY value * up, model) AS worst_value FROM vals GROUP BY dataset, metric""",
    doubles=["best_value", "worst_value"],
)
def best_and_worst(spark, sf):
    rows = predictions(spark, sf)
    sc.custom_metric("length_gap", lambda df: df.groupBy(*ov.GROUP).agg(F.avg(F.abs(F.length("prediction") - F.length("reference"))).alias("value")), False)
    sc.fold_metric("length_correlation", LENGTH_CORRELATION)
    return sc.best_and_worst(sc.calculate_all(rows, [], ["length_gap", "length_correlation"]))


@query(
    "custom_metric",
    f"{R} SELECT dataset, model, 'length_gap' AS metric, avg(abs(length(prediction) - length(reference))) AS value FROM predictions GROUP BY dataset, model",
    doubles=["value"],
)
def custom_metric(spark, sf):
    def gap(df):
        return df.groupBy(*ov.GROUP).agg(F.avg(F.abs(F.length("prediction") - F.length("reference"))).alias("value"))

    sc.custom_metric("length_gap", gap, higher_is_better=False)
    return sc.calculate_all(predictions(spark, sf), [], ["length_gap"])
