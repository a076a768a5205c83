"""Queries: sources, validation, cleaning, dedup, templates, tokens, statistics, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions import profiles as lp
from tablewright.functions import text as tx
from tablewright.functions.language import STOP_WORDS, detect_language
from tablewright.operators import clean as cl
from tablewright.operators import dedup as dd
from tablewright.operators import mix as mx
from tablewright.operators import split as sp
from tablewright.operators import stats as st
from tablewright.operators import templates as tp
from tablewright.operators import tokens as tk
from tablewright.operators import validate as va
from tablewright.operators.scan import RowNumber, scan
from tablewright.plans.registry import SQL, query
from tablewright.plans.views import (
    DOC_RECORDS,
    PAIRS,
    SPACE,
    doc_records,
    pairs,
    sql_key,
    sql_repetition,
    sql_strip,
    sql_unit,
    sql_words,
    table,
)
from tablewright.session import fresh_folder
from tablewright.sources import readers as rd
from tablewright.sources import writers as wr

P, D = f"WITH {PAIRS}", f"WITH {DOC_RECORDS}"
RATIOS = {"train": 0.8, "validation": 0.1, "test": 0.1}

# --- sources -----------------------------------------------------------------

PAIR_COLUMNS = "row_id, dataset, instruction, input, output"


@query("read_jsonl", f"{P} SELECT {PAIR_COLUMNS} FROM pairs")
def read_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_folder(spark, "jsonl")
    wr.write_jsonl(pairs(spark, sf), path)
    return rd.read_jsonl(spark, path, rd.RECORD).drop(rd.CORRUPT)


@query("read_csv", "SELECT page_id, url, html AS text FROM pages")
def read_csv(spark, sf):
    path = fresh_folder(spark, "csv")
    table(spark, sf, "pages").write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    schema = T.StructType.fromDDL("page_id long, url string, html string")
    return rd.read_csv(spark, path, schema, text_column="html")


@query("read_parquet", "SELECT doc_id, lang, source, text, 'train' AS split FROM documents")
def read_parquet(spark, sf):
    found = rd.read_parquet(spark, {"train": f"{sf}/documents.parquet", "test": f"{sf}/missing.parquet"})
    return found.select("doc_id", "lang", "source", "text", "split")


def _catalog(sf: str, max_samples: int | None = 100) -> list[rd.Dataset]:
    return [
        rd.Dataset("docs", f"{sf}/documents.parquet", mapping={"row_id": "doc_id", "text": "text"}, max_samples=max_samples),
        rd.Dataset("bench", f"{sf}/benchmark.parquet", mapping={"row_id": "item_id", "input": ""}, is_eval=True),
    ]


NAMED = """named AS (
  SELECT 'docs' AS dataset, row_id, text FROM (
    SELECT doc_id AS row_id, text, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 100
  UNION ALL SELECT 'bench', item_id, text FROM benchmark)"""


@query("read_named", f"WITH {NAMED} SELECT dataset, row_id, text FROM named")
def read_named(spark, sf):
    return rd.read_named(spark, _catalog(sf)).select("dataset", "row_id", "text")


@query(
    "head_n",
    f"""{D} SELECT dataset, row_id, instruction FROM
    (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY row_id) AS rn FROM doc_records) WHERE rn <= 20""",
)
def head_n(spark, sf):
    return sp.head_n(doc_records(spark, sf), 20).select("dataset", "row_id", "instruction")


@query("map_columns", "SELECT doc_id AS row_id, text AS instruction, lang, source, n_chars FROM documents")
def map_columns(spark, sf):
    return rd.map_columns(table(spark, sf, "documents"), {"row_id": "doc_id", "instruction": "text", "input": ""})


TURN_PAIRS = """turn_pairs AS (
  SELECT conv_id, turn, text AS instruction, coalesce(sys, '') AS input, nxt AS output FROM (
    SELECT *, lead(text) OVER w AS nxt, lead(role) OVER w AS nrole,
           arg_max(CASE WHEN role = 'system' THEN text END, CASE WHEN role = 'system' THEN turn END)
             OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sys
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) t
  WHERE role = 'user' AND nrole = 'assistant')"""


@query("conversations_to_pairs", f"WITH {TURN_PAIRS} SELECT * FROM turn_pairs")
def conversations_to_pairs(spark, sf):
    return rd.conversations_to_pairs(table(spark, sf, "conversations"))


@query(
    "read_log_json",
    """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, event_id AS step, event_type AS metric, value FROM events""",
)
def read_log_json(spark, sf):
    events = table(spark, sf, "events")
    line = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.lit("INFO").alias("level"),
        F.lit("step done").alias("message"),
        F.col("event_id").alias("step"),
        *[F.when(F.col("event_type") == e, F.col("value")).alias(e) for e in ("signup", "view", "purchase", "click", "error")],
    )
    path = fresh_folder(spark, "logs")
    events.select(F.to_json(line)).write.text(path)
    return rd.log_metrics(rd.read_log_json(spark, path))


@query("select_dataset", f"{D} SELECT row_id, dataset, lang FROM doc_records WHERE dataset = 'src3'")
def select_dataset(spark, sf):
    return rd.select_dataset(doc_records(spark, sf), "src3").select("row_id", "dataset", "lang")


# --- validation and filters --------------------------------------------------

MARK = "{c}"
BLANK = "NOT regexp_matches({c}, '[^" + SPACE + "]')"


def _blank(c: str) -> str:
    return BLANK.replace("{c}", c)


REASON = f"""CASE WHEN instruction IS NULL OR output IS NULL THEN 'null_required'
  WHEN {_blank('instruction')} OR {_blank('output')} THEN 'blank_required'
  WHEN length(instruction) NOT BETWEEN 10 AND 8192 THEN 'instruction_length'
  WHEN length(output) NOT BETWEEN 5 AND 16384 THEN 'output_length' END"""


@query("require_columns", f"{D} SELECT row_id FROM doc_records")
def require_columns(spark, sf):
    return va.require_columns(doc_records(spark, sf), ["instruction", "output"]).select("row_id")


@query("drop_null_required", f"{D} SELECT row_id, dataset FROM doc_records WHERE instruction IS NOT NULL AND output IS NOT NULL")
def drop_null_required(spark, sf):
    return va.drop_null_required(doc_records(spark, sf)).select("row_id", "dataset")


@query(
    "drop_blank_required",
    f"{D} SELECT row_id, dataset FROM doc_records WHERE NOT ({_blank('instruction')}) AND NOT ({_blank('output')})",
)
def drop_blank_required(spark, sf):
    return va.drop_blank_required(doc_records(spark, sf)).select("row_id", "dataset")


@query(
    "length_bounds",
    f"""{D} SELECT row_id, length(instruction) AS n_instruction FROM doc_records
    WHERE length(instruction) BETWEEN 10 AND 8192 AND length(output) BETWEEN 5 AND 16384""",
)
def length_bounds(spark, sf):
    return va.length_bounds(doc_records(spark, sf)).select("row_id", F.length("instruction").cast("long").alias("n_instruction"))


@query("validate", f"{D} SELECT row_id, dataset, instruction, output FROM doc_records WHERE ({REASON}) IS NULL")
def validate(spark, sf):
    return va.validate(doc_records(spark, sf)).select("row_id", "dataset", "instruction", "output")


@query(
    "validate_reject_counts",
    f"{D} SELECT reason, count(*) AS n FROM (SELECT {REASON} AS reason FROM doc_records) WHERE reason IS NOT NULL GROUP BY reason",
)
def validate_reject_counts(spark, sf):
    return va.reject_counts(doc_records(spark, sf))


@query("drop_any_null", f"{D} SELECT row_id, lang FROM doc_records WHERE output IS NOT NULL")
def drop_any_null(spark, sf):
    return cl.drop_any_null(doc_records(spark, sf)).select("row_id", "lang")


@query(
    "length_ratio_filter",
    f"""{D} SELECT row_id FROM doc_records
    WHERE length(instruction) > 0 AND CAST(length(output) AS DOUBLE) / length(instruction) BETWEEN 0.1 AND 10.0""",
)
def length_ratio_filter(spark, sf):
    return va.length_ratio_filter(doc_records(spark, sf)).select("row_id")


@query("repetition_filter", f"SELECT doc_id FROM ({sql_repetition('documents', 'text', 'doc_id')}) WHERE ratio <= 0.05")
def repetition_filter(spark, sf):
    return va.repetition_filter(table(spark, sf, "documents"), "text", 4, 0.05).select("doc_id")


@query(
    "score_threshold_filter",
    "SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic IS NULL OR l.toxic <= 0.5",
)
def score_threshold_filter(spark, sf):
    docs = table(spark, sf, "documents")
    return va.score_threshold_filter(docs, table(spark, sf, "labels"), "doc_id", "toxic", 0.5).select("doc_id", "lang")


def _lang_sql(text: str) -> str:
    tokens = f"regexp_extract_all(lower({text}), '\\p{{L}}+')"
    hits = [
        f"{{'n': len(list_filter({tokens}, lambda t: t IN ({', '.join(chr(39) + w + chr(39) for w in words)}))), 'lang': '{lang}'}}"
        for lang, words in sorted(STOP_WORDS.items())
    ]
    return f"list_max([{', '.join(hits)}])"


DETECTED = f"""detected AS (
  SELECT doc_id, lang, CASE WHEN best.n > 0 THEN best.lang ELSE 'und' END AS detected
  FROM (SELECT doc_id, lang, {_lang_sql('text')} AS best FROM documents))"""


@query("detect_language", f"WITH {DETECTED} SELECT doc_id, detected FROM detected")
def detect(spark, sf):
    return table(spark, sf, "documents").select("doc_id", detect_language("text").alias("detected"))


@query("language_filter", f"WITH {DETECTED} SELECT doc_id, lang FROM detected WHERE detected = 'en'")
def language_filter(spark, sf):
    return va.language_filter(table(spark, sf, "documents"), "text", "en").select("doc_id", "lang")


@query("language_distribution", f"WITH {DETECTED} SELECT lang, detected, count(*) AS n FROM detected GROUP BY 1, 2")
def language_distribution(spark, sf):
    return st.language_distribution(table(spark, sf, "documents"), "text", by=["lang"])


_LOWER_WORDS = "regexp_extract_all(lower(text), '\\p{L}+')"
PROFILES = f"""words AS (SELECT doc_id, lang, unnest({_LOWER_WORDS}) AS w FROM documents),
grams AS (SELECT doc_id, lang, unnest(list_transform(range(1, CAST(length(w) AS BIGINT) + 1), lambda i: substr(' ' || w || ' ', i, 3))) AS gram FROM words),
counts AS (SELECT lang, gram, count(*) AS n FROM grams WHERE lang IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, sum(n) + count(*) + 1 AS "all" FROM counts GROUP BY lang),
top AS (SELECT lang, gram, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS rn FROM counts) WHERE rn <= 500
  UNION ALL SELECT lang, '', 0 FROM totals),
profiles AS (SELECT lang, gram, CAST(floor(1000 * ln((n + 1) / CAST("all" AS DOUBLE))) AS BIGINT) AS points FROM top JOIN totals USING (lang))"""
PROFILED = f"""{PROFILES}, seen AS (SELECT doc_id, gram, count(*) AS n FROM grams GROUP BY ALL),
scored AS (SELECT s.doc_id, o.lang, sum(s.n * coalesce(p.points, o.points)) AS points
  FROM seen s JOIN profiles o ON o.gram = '' LEFT JOIN profiles p ON p.lang = o.lang AND p.gram = s.gram GROUP BY ALL),
best AS (SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY points DESC, lang) AS rn FROM scored) WHERE rn = 1),
profiled AS (SELECT d.doc_id, coalesce(b.lang, 'und') AS detected FROM documents d LEFT JOIN best b USING (doc_id))"""


@query("language_profiles", f"WITH {PROFILES} SELECT lang, gram, points FROM profiles")
def language_profiles(spark, sf):
    return lp.learn_profiles(table(spark, sf, "documents"), "text", "lang")


def _profiled(spark, sf):
    docs = table(spark, sf, "documents")
    return lp.profiled_language(docs, "text", lp.learn_profiles(docs, "text", "lang"), "doc_id")


@query("profiled_language", f"WITH {PROFILED} SELECT doc_id, detected FROM profiled")
def profiled_language(spark, sf):
    return _profiled(spark, sf)


@query(
    "expected_languages",
    f"""WITH {PROFILED}, counted AS (SELECT detected AS lang, count(*) AS n FROM profiled GROUP BY 1),
    wanted AS (SELECT unnest(['de', 'en', 'it']) AS lang, true AS expected)
    SELECT lang, coalesce(n, 0) AS n, coalesce(expected, false) AS expected,
      CASE WHEN n IS NULL THEN 'missing' WHEN expected THEN 'present' ELSE 'unexpected' END AS status
    FROM counted FULL JOIN wanted USING (lang)""",
)
def expected_languages(spark, sf):
    return lp.expected_languages(_profiled(spark, sf), ["de", "en", "it"])


@query(
    "is_eval_filter",
    """WITH named AS (SELECT 'docs' AS dataset, doc_id AS row_id FROM documents UNION ALL SELECT 'bench', item_id FROM benchmark)
    SELECT dataset, row_id FROM named WHERE dataset = 'docs'""",
)
def is_eval_filter(spark, sf):
    catalog = _catalog(sf, None)
    rows = rd.read_named(spark, catalog)
    return va.is_eval_filter(rows, rd.catalog_table(spark, catalog)).select("dataset", "row_id")


# --- cleaning ----------------------------------------------------------------


@query("strip_text", f"SELECT page_id, {sql_strip('chr(9) || chr(160) || html || chr(8195) || chr(10)')} AS text FROM pages")
def strip_text(spark, sf):
    padded = F.concat(F.lit("\t "), F.col("html"), F.lit(" \n"))
    return table(spark, sf, "pages").select("page_id", tx.strip(padded).alias("text"))


@query("normalize_nfkc")
def normalize_nfkc(spark, sf):
    return table(spark, sf, "documents").select("doc_id", cl.nfkc("text").alias("text"))


@query("remove_tags", "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS text FROM pages")
def remove_tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.remove_tags("html").alias("text"))


CLEAN = "regexp_replace(" + sql_strip("{c}") + ", '<[^>]+>', '', 'g')"


@query(
    "clean",
    f"""{D} SELECT row_id, {CLEAN.replace('{c}', 'dataset')} AS dataset, {CLEAN.replace('{c}', 'instruction')} AS instruction,
    {CLEAN.replace('{c}', 'input')} AS input, {CLEAN.replace('{c}', 'output')} AS output, lang FROM doc_records WHERE output IS NOT NULL""",
)
def clean(spark, sf):
    return cl.clean(doc_records(spark, sf))


@query(
    "custom_cleaners",
    f"SELECT doc_id, lower(regexp_replace({sql_strip('text')}, '[{SPACE}]+', ' ', 'g')) AS text FROM documents",
)
def custom_cleaners(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return cl.clean(docs, markup=False, custom=["squeeze", "lower"])


@query(
    "truncate_text",
    "SELECT doc_id, CASE WHEN length(text) <= 80 THEN text ELSE substr(text, 1, 77) || '...' END AS text FROM documents",
)
def truncate_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.truncate_text("text", 80).alias("text"))


@query(
    "chunk_text",
    """SELECT doc_id, i AS chunk, array_to_string(w[i * 40 + 1:i * 40 + 50], ' ') AS text FROM (
      SELECT doc_id, w, unnest(range(0, CAST(greatest(0, ceil((len(w) - 50) / 40.0)) AS BIGINT) + 1)) AS i
      FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))""",
)
def chunk_text(spark, sf):
    chunks = F.posexplode(tx.chunk_text("text", 50, 10)).alias("chunk", "text")
    return table(spark, sf, "documents").select("doc_id", chunks).withColumn("chunk", F.col("chunk").cast("long"))


@query(
    "ngrams",
    f"""SELECT doc_id, len(g) AS n_grams, len(list_distinct(g)) AS n_distinct, g[1] AS first_gram FROM (
      SELECT doc_id, list_transform(range(1, CAST(len(w) AS BIGINT) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) AS g
      FROM (SELECT doc_id, {sql_words('text')} AS w FROM documents))""",
)
def ngrams(spark, sf):
    g = F.col("g")
    docs = table(spark, sf, "documents").select("doc_id", tx.ngrams(tx.words("text"), 3, " ").alias("g"))
    return docs.select(
        "doc_id",
        F.size(g).cast("long").alias("n_grams"),
        F.size(F.array_distinct(g)).cast("long").alias("n_distinct"),
        F.get(g, F.lit(0)).alias("first_gram"),
    )


@query(
    "inject_noise",
    f"""SELECT doc_id, array_to_string(list_transform(list_filter(list_zip(w, range(0, CAST(len(w) AS BIGINT))),
        lambda x: {sql_unit("md5('42:' || CAST(doc_id AS VARCHAR) || ':' || CAST(x[2] AS VARCHAR))")} >= 0.1),
        lambda x: x[1]), ' ') AS text
    FROM (SELECT doc_id, {sql_words('text')} AS w FROM documents)""",
)
def inject_noise(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return cl.inject_noise(docs, "text", "doc_id", 0.1, ["delete"])


# --- dedup -------------------------------------------------------------------


@query(
    "dedup",
    f"""{D} SELECT row_id, dataset, instruction, output FROM (
      SELECT *, row_number() OVER (PARTITION BY instruction, input, output ORDER BY row_id) AS rn FROM doc_records) WHERE rn = 1""",
)
def dedup(spark, sf):
    return dd.dedup(doc_records(spark, sf)).select("row_id", "dataset", "instruction", "output")


@query(
    "duplicate_count",
    f"""{D} SELECT dataset, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates FROM (
      SELECT dataset, instruction, input, output, count(*) AS n FROM doc_records GROUP BY ALL) GROUP BY dataset""",
)
def duplicate_count(spark, sf):
    return dd.duplicate_count(doc_records(spark, sf))


@query(
    "duplicate_groups",
    f"""{D} SELECT count(*) AS n_rows, min(row_id) AS first_row, max(row_id) AS last_row FROM doc_records
    GROUP BY instruction, input, output HAVING count(*) > 1""",
)
def duplicate_groups(spark, sf):
    return dd.duplicate_groups(doc_records(spark, sf))


# --- templates ---------------------------------------------------------------

I, N, O = sql_strip("instruction"), sql_strip("input"), sql_strip("output")
USER = f"(CASE WHEN {N} <> '' THEN {I} || chr(10) || chr(10) || {N} ELSE {I} END)"


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _template_sql(body: str) -> str:
    return f"{P} SELECT row_id, replace({body}, '¶', chr(10)) AS text FROM pairs"


def _format(name: str, **options):
    return lambda spark, sf: tp.format_table(pairs(spark, sf), name, **options)


# The pilcrow stands for a newline in these statements; the tables do not contain it.
query(
    "format_alpaca",
    _template_sql(
        f"'### Instruction:¶' || {I} || CASE WHEN {N} <> '' THEN '¶¶### Input:¶' || {N} ELSE '' END || '¶¶### Response:¶' || {O} || '</s>'"
    ),
)(_format("alpaca", eos="</s>"))
query(
    "format_chatml",
    _template_sql(
        f"'<|im_start|>system¶You are a helpful assistant.<|im_end|>¶<|im_start|>user¶' || {USER} || "
        f"'<|im_end|>¶<|im_start|>assistant¶' || {O} || '<|im_end|>'"
    ),
)(_format("chatml"))
query(
    "format_chatml_legacy",
    _template_sql(
        f"'im_start>system¶You are a helpful assistant.im_end>¶im_start>user¶' || {USER} || "
        f"'im_end>¶im_start>assistant¶' || {O} || 'im_end>'"
    ),
)(_format("chatml_legacy"))
query(
    "format_llama3",
    _template_sql(
        "'<|begin_of_text|><|start_header_id|>system<|end_header_id|>¶¶You are a helpful assistant.<|eot_id|>"
        f"<|start_header_id|>user<|end_header_id|>¶¶' || {USER} || '<|eot_id|><|start_header_id|>assistant<|end_header_id|>¶¶' || {O} || '<|eot_id|><|eot_id|>'"
    ),
)(_format("llama3", eos="<|eot_id|>"))
query(
    "format_vicuna",
    _template_sql(f"{_lit(tp.VICUNA_SYSTEM)} || '¶¶USER: ' || {USER} || '¶ASSISTANT: ' || {O}"),
)(_format("vicuna"))
query(
    "format_zephyr",
    _template_sql(
        f"'<|system|>¶You are a helpful assistant.</s>¶<|user|>¶' || {USER} || '</s>¶<|assistant|>¶' || {O} || '</s>'"
    ),
)(_format("zephyr"))
query("format_plain", "SELECT doc_id, text || '</s>' AS text FROM documents")(
    lambda spark, sf: tp.format_table(table(spark, sf, "documents"), "plain", ids=["doc_id"], eos="</s>")
)
query(
    "format_custom",
    _template_sql(f"CASE WHEN {N} <> '' THEN {I} || ' [' || {N} || '] -> ' || {O} ELSE {I} || ' -> ' || {O} END"),
)(_format("custom", custom="{instruction} -> {output}", custom_with_input="{instruction} [{input}] -> {output}"))


@query(
    "format_table_by_row",
    f"""{P} SELECT row_id, replace(CASE row_id % 2 WHEN 0
      THEN '### Instruction:¶' || {I} || CASE WHEN {N} <> '' THEN '¶¶### Input:¶' || {N} ELSE '' END || '¶¶### Response:¶' || {O}
      ELSE {_lit(tp.VICUNA_SYSTEM)} || '¶¶USER: ' || {USER} || '¶ASSISTANT: ' || {O} END, '¶', chr(10)) AS text FROM pairs""",
)
def format_table_by_row(spark, sf):
    rows = pairs(spark, sf).withColumn("template", F.when(F.col("row_id") % 2 == 0, "alpaca").otherwise("vicuna"))
    return tp.format_table(rows, template_column="template")


RAW_USER = "(CASE WHEN input <> '' THEN instruction || chr(10) || chr(10) || input ELSE instruction END)"


@query(
    "format_inference_prompt",
    _template_sql(
        f"'<|system|>¶You are a helpful assistant.<|end|>¶<|user|>¶' || {RAW_USER} || '<|end|>¶<|assistant|>¶'"
    ),
)
def format_inference_prompt(spark, sf):
    return pairs(spark, sf).select("row_id", tp.inference_prompt("zephyr").alias("text"))


@query(
    "render_chat",
    """SELECT conv_id, string_agg(role || ': ' || text || chr(10), '' ORDER BY turn) || 'assistant: ' AS text
    FROM conversations GROUP BY conv_id""",
)
def render_chat(spark, sf):
    return tp.render_chat(table(spark, sf, "conversations"))


# --- tokens ------------------------------------------------------------------

VOCAB = f"""vocab AS (
  SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 3 AS token_id FROM (
    SELECT token, count(*) AS n FROM (SELECT unnest({sql_words('text')}) AS token FROM documents) GROUP BY token)
  QUALIFY row_number() OVER (ORDER BY n DESC, token) <= 1996)"""
ENCODED = f"""{VOCAB}, flat AS (
  SELECT doc_id, unnest(w) AS token, unnest(range(0, CAST(len(w) AS BIGINT))) AS spot
  FROM (SELECT doc_id, {sql_words('text')} AS w FROM documents)), encoded AS (
  SELECT d.doc_id, coalesce(e.ids, []) AS ids FROM documents d LEFT JOIN (
    SELECT doc_id, list(coalesce(token_id, 1) ORDER BY spot) AS ids FROM flat LEFT JOIN vocab USING (token) GROUP BY doc_id) e
  ON e.doc_id = d.doc_id)"""


def _vocab(spark, sf):
    return tk.build_vocab(table(spark, sf, "documents"), "text", 2000)


def _encoded(spark, sf, **options):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return tk.encode(docs, "text", _vocab(spark, sf), "doc_id", **{"max_length": None, **options})


@query(
    "build_vocab",
    f"""WITH {VOCAB} SELECT token, CAST(token_id AS INT) AS token_id, n FROM vocab
    UNION ALL SELECT * FROM (VALUES ('<pad>', 0, 0), ('<unk>', 1, 0), ('<s>', 2, 0), ('</s>', 3, 0))""",
)
def build_vocab(spark, sf):
    return _vocab(spark, sf)


@query(
    "encode",
    f"""WITH {ENCODED} SELECT doc_id, array_to_string(list_concat([2], ids[1:254], [3]), ' ') AS input_ids,
    least(len(ids), 254) + 2 AS n_mask FROM encoded""",
)
def encode(spark, sf):
    rows = _encoded(spark, sf, max_length=256, add_bos=True, add_eos=True)
    return rows.select("doc_id", F.array_join("input_ids", " ").alias("input_ids"), F.size("attention_mask").cast("long").alias("n_mask"))


def _padded(spark, sf):
    docs = tk.assign_batches(_encoded(spark, sf), 16, "doc_id")
    return tk.pad(docs)


PADDED = f"""{ENCODED}, batched AS (
  SELECT doc_id, ids, (row_number() OVER (ORDER BY doc_id) - 1) // 16 AS batch FROM encoded), padded AS (
  SELECT doc_id, batch, ids, CAST(ceil(max(len(ids)) OVER (PARTITION BY batch) / 8.0) * 8 AS BIGINT) AS width FROM batched)"""


@query(
    "pad_batches",
    f"""WITH {PADDED} SELECT doc_id, batch, array_to_string(list_concat(ids, list_transform(range(0, width - len(ids)), lambda i: 0)), ' ') AS input_ids,
    len(ids) AS n_real FROM padded""",
)
def pad_batches(spark, sf):
    real = F.aggregate("attention_mask", F.lit(0), lambda a, b: a + b)
    return _padded(spark, sf).select("doc_id", "batch", F.array_join("input_ids", " ").alias("input_ids"), real.cast("long").alias("n_real"))


@query(
    "build_labels",
    f"""WITH {PADDED} SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(0, width - len(ids)), lambda i: -100)), ' ') AS labels FROM padded""",
)
def build_labels(spark, sf):
    return tk.build_labels(_padded(spark, sf)).select("doc_id", F.array_join("labels", " ").alias("labels"))


@query(
    "assign_batches",
    """SELECT doc_id, batch FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 64 AS batch,
    count(*) OVER () AS total FROM documents) WHERE batch < total // 64""",
)
def assign_batches(spark, sf):
    return tk.assign_batches(table(spark, sf, "documents").select("doc_id"), 64, "doc_id", drop_last=True)


PCT = [0, 25, 50, 75, 90, 95, 99, 100]


def _pct_sql(value: str) -> str:
    return ", ".join(f"quantile_cont({value}, {p / 100}) AS p{p}" for p in PCT)


PCT_NAMES = [f"p{p}" for p in PCT]
WORDS_PER_DOC = f"SELECT doc_id, source, CAST(len({sql_words('text')}) AS INT) AS size FROM documents"


@query(
    "analyze_sequences",
    f"""SELECT count(*) AS n_sequences, avg(size) AS mean, stddev_pop(size) AS std, min(size) AS min, max(size) AS max,
    count(*) FILTER (size >= 512) AS at_limit, avg(CASE WHEN size >= 512 THEN 1.0 ELSE 0.0 END) AS at_limit_ratio, {_pct_sql('size')}
    FROM (SELECT doc_id, source, least(size, 512) AS size FROM ({WORDS_PER_DOC}))""",
    doubles=["mean", "std", "at_limit_ratio", *PCT_NAMES],
)
def analyze_sequences(spark, sf):
    return tk.analyze_sequences(_encoded(spark, sf, max_length=512), 512)


@query(
    "analyze_sequences_whole",
    f"""SELECT count(*) AS n_sequences, avg(size) AS mean, stddev_pop(size) AS std, min(size) AS min, max(size) AS max,
    count(*) FILTER (size >= 512) AS at_limit, avg(CASE WHEN size >= 512 THEN 1.0 ELSE 0.0 END) AS at_limit_ratio, {_pct_sql('size')}
    FROM ({WORDS_PER_DOC})""",
    doubles=["mean", "std", "at_limit_ratio", *PCT_NAMES],
)
def analyze_sequences_whole(spark, sf):
    """Whole sequences against the limit."""
    return tk.analyze_sequences(_encoded(spark, sf), 512)


@query(
    "pack_sequences",
    f"""WITH {ENCODED}, spans AS (
      SELECT flat.doc_id, coalesce(token_id, 1) AS id, row_number() OVER (ORDER BY flat.doc_id, spot) - 1 AS pos
      FROM flat LEFT JOIN vocab USING (token))
    SELECT pos // 512 AS block, array_to_string(list(id ORDER BY pos), ' ') AS input_ids FROM spans GROUP BY 1""",
)
def pack_sequences(spark, sf):
    return tk.pack_sequences(_encoded(spark, sf), 512, "doc_id").select("block", F.array_join("input_ids", " ").alias("input_ids"))


@query(
    "token_statistics",
    f"""SELECT source, avg(size) AS mean_tokens, stddev_pop(size) AS std_tokens, min(size) AS min_tokens, max(size) AS max_tokens,
    median(size) AS median_tokens FROM ({WORDS_PER_DOC}) GROUP BY source""",
    doubles=["mean_tokens", "std_tokens", "median_tokens"],
)
def token_statistics(spark, sf):
    ids = _encoded(spark, sf).join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    return tk.token_statistics(ids, ["source"])


# --- statistics --------------------------------------------------------------

FIELDS = ["instruction", "input", "output"]


def _length_sql(by: str = "") -> str:
    long = " UNION ALL ".join(
        f"SELECT {by}'{c}' AS \"column\", CAST(length({c}) AS INT) AS size FROM doc_records" for c in FIELDS
    )
    return f"""SELECT {by}"column", count(size) AS n, avg(size) AS mean, stddev_pop(size) AS std, min(size) AS min, max(size) AS max,
    {_pct_sql('size')} FROM ({long}) GROUP BY ALL"""


@query("length_stats", f"{D} {_length_sql('lang, ')}", doubles=["mean", "std", *PCT_NAMES])
def length_stats(spark, sf):
    return st.length_stats(doc_records(spark, sf), FIELDS, by=["lang"])


def _counts_sql(test: str, name: str, columns: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({test.replace(MARK, c)}) AS {name} FROM doc_records" for c in columns
    )
    return f"SELECT * FROM ({parts}) WHERE {name} > 0"


ALL_FIELDS = ["row_id", "dataset", "instruction", "input", "output", "lang"]


@query("null_counts", f"{D} {_counts_sql('{c} IS NULL', 'n_null', ALL_FIELDS)}")
def null_counts(spark, sf):
    return st.null_counts(doc_records(spark, sf))


@query("empty_counts", f"{D} {_counts_sql(BLANK, 'n_empty', ALL_FIELDS[1:])}")
def empty_counts(spark, sf):
    return st.empty_counts(doc_records(spark, sf))


LENGTH_FACTS = ["n", "mean", "std", "min", "max", *PCT_NAMES]


@query(
    "profile",
    f"""{D}, lengths AS ({_length_sql()}), wide AS (
      SELECT "column", {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in LENGTH_FACTS)} FROM lengths)
    SELECT 'shape' AS section, '*' AS "column", 'num_samples' AS stat, CAST(count(*) AS DOUBLE) AS value FROM doc_records
    UNION ALL SELECT 'shape', '*', 'num_columns', 6.0
    UNION ALL SELECT 'length', "column", stat, value FROM (UNPIVOT wide ON {', '.join(LENGTH_FACTS)} INTO NAME stat VALUE value)
    UNION ALL SELECT 'nulls', "column", 'n_null', CAST(n_null AS DOUBLE) FROM ({_counts_sql('{c} IS NULL', 'n_null', ALL_FIELDS)})
    UNION ALL SELECT 'blanks', "column", 'n_empty', CAST(n_empty AS DOUBLE) FROM ({_counts_sql(BLANK, 'n_empty', ALL_FIELDS[1:])})""",
    doubles=["value"],
)
def profile(spark, sf):
    return st.profile(doc_records(spark, sf), FIELDS)


_TOTAL = " + ".join(f"coalesce(length({c}), 0)" for c in FIELDS)
FULL_PROFILE = f"""WITH base AS ({SQL["profile"]}), {D.removeprefix("WITH ")}, sizes AS (SELECT {_TOTAL} AS n FROM doc_records),
    copies AS (SELECT count(*) AS c FROM doc_records GROUP BY {', '.join(FIELDS)}),
    spoken AS (SELECT CASE WHEN best.n > 0 THEN best.lang ELSE 'und' END AS lang FROM (SELECT {_lang_sql('output')} AS best FROM doc_records))
    SELECT * FROM base
    UNION ALL SELECT 'columns', unnest({ALL_FIELDS!r}), 'place', CAST(unnest(range({len(ALL_FIELDS)})) AS DOUBLE)
    UNION ALL SELECT 'duplicates', '*', 'n_duplicates', CAST(sum(c - 1) AS DOUBLE) FROM copies
    UNION ALL SELECT 'total_length', '*', unnest(['mean', 'std', 'min', 'max', 'sum']), unnest([avg(n), stddev_pop(n), min(n), max(n), sum(n)]::DOUBLE[]) FROM sizes
    UNION ALL SELECT 'languages', 'output', coalesce(lang, 'und'), CAST(count(*) AS DOUBLE) FROM spoken GROUP BY lang"""


@query("full_profile", FULL_PROFILE, doubles=["value"])
def full_profile(spark, sf):
    return st.full_profile(doc_records(spark, sf), FIELDS, FIELDS, "output")


@query(
    "sample_rows",
    f"SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY {sql_key(42, 'doc_id')}, doc_id) AS rn FROM documents) WHERE rn <= 250",
)
def sample_rows(spark, sf):
    return st.sample_rows(table(spark, sf, "documents"), 250, 42, "doc_id").select("doc_id", "lang")


@query(
    "word_length_stats",
    f"""SELECT source, avg(size) AS mean_length, stddev_pop(size) AS std_length, min(size) AS min_length, max(size) AS max_length,
    median(size) AS median_length FROM ({WORDS_PER_DOC}) GROUP BY source""",
    doubles=["mean_length", "std_length", "median_length"],
)
def word_length_stats(spark, sf):
    return st.word_length_stats(table(spark, sf, "documents"), "text", ["source"])


@query(
    "dataset_fingerprint",
    """SELECT count(*) AS n_rows, CAST(sum(CAST('0x' || substr(md5(length(text) || ':' || text || length(lang) || ':' || lang), 1, 12) AS BIGINT)) AS VARCHAR)
    AS fingerprint FROM documents""",
)
def dataset_fingerprint(spark, sf):
    return st.dataset_fingerprint(table(spark, sf, "documents"), ["text", "lang"])


@query("top_k", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def top_k(spark, sf):
    return st.top_k(table(spark, sf, "documents").select("doc_id", "n_chars"), "n_chars", 25, "doc_id")


# --- splits and mixing -------------------------------------------------------


def _split_sql(order: str, train: float = 0.8, rest: float = 0.1) -> str:
    return f"""SELECT row_id, CASE WHEN rn <= c1 THEN 'train' WHEN rn <= c1 + c2 THEN 'validation' ELSE 'test' END AS split FROM (
      SELECT doc_id AS row_id, row_number() OVER (ORDER BY {order}) AS rn,
        greatest(CAST(floor(count(*) OVER () * CAST({train} AS DOUBLE)) AS BIGINT), 1) AS c1,
        greatest(CAST(floor(count(*) OVER () * CAST({rest} AS DOUBLE)) AS BIGINT), 1) AS c2 FROM documents)
    WHERE rn <= c1 + c2 + c2"""


def _ids(spark, sf):
    return table(spark, sf, "documents").withColumnRenamed("doc_id", "row_id")


@query("split_random", _split_sql(sql_key(42, "doc_id") + ", doc_id"))
def split_random(spark, sf):
    return sp.split_random(_ids(spark, sf), RATIOS).select("row_id", "split")


@query("split_sequential", _split_sql("doc_id"))
def split_sequential(spark, sf):
    return sp.split_sequential(_ids(spark, sf), RATIOS).select("row_id", "split")


@query(
    "split_stratified",
    f"""SELECT row_id, lang, CASE WHEN rn <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train'
      WHEN rn <= floor(n * CAST(0.9 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM (
      SELECT doc_id AS row_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {sql_key(42, 'doc_id')}, doc_id) AS rn,
      count(*) OVER (PARTITION BY lang) AS n FROM documents)""",
)
def split_stratified(spark, sf):
    return sp.split_stratified(_ids(spark, sf), "lang", RATIOS).select("row_id", "lang", "split")


@query("validate_ratios", _split_sql(sql_key(42, "doc_id") + ", doc_id", 0.5, 0.25))
def validate_ratios(spark, sf):
    ratios = {"train": 0.5, "validation": 0.25, "test": 0.25}
    sp.validate_ratios(ratios)
    return sp.split_random(_ids(spark, sf), ratios).select("row_id", "split")


@query(
    "split_hash",
    f"""SELECT doc_id AS row_id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT doc_id, {sql_unit(sql_key(42, 'doc_id'))} AS u FROM documents)""",
)
def split_hash(spark, sf):
    return sp.split_hash(_ids(spark, sf), RATIOS).select("row_id", "split")


def _mix_sql(total: str, weight: str, seed: int = 42, extra: str = "") -> str:
    """Rows per source by weight; the first rows in seeded order fill a partial copy."""
    return f"""SELECT row_id, dataset, unnest(range(1, copies + 1)) AS copy{extra} FROM (
      SELECT row_id, dataset, target // n + CASE WHEN rn <= target % n THEN 1 ELSE 0 END AS copies FROM (
        SELECT *, CAST(floor(CAST({total} AS DOUBLE) * w / (SELECT sum(w) FROM (SELECT DISTINCT dataset, w FROM sized))) AS BIGINT) AS target FROM (
          SELECT * FROM sized)))"""


def _sized(weight: str, seed: int = 42) -> str:
    return f"""sized AS (SELECT doc_id AS row_id, lang AS dataset, CAST({weight} AS DOUBLE) AS w,
      count(*) OVER (PARTITION BY lang) AS n,
      row_number() OVER (PARTITION BY lang ORDER BY {sql_key(seed, 'doc_id')}, doc_id) AS rn FROM documents)"""


def _by_lang(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("dataset"))


WEIGHTS = {"en": 1.0, "de": 5.0, "fr": 2.0, "es": 0.5}
WEIGHT_CASE = "CASE lang WHEN 'en' THEN 1.0 WHEN 'de' THEN 5.0 WHEN 'fr' THEN 2.0 ELSE 0.5 END"


@query("mix_proportional", f"WITH {_sized('count(*) OVER (PARTITION BY lang)')} {_mix_sql('(SELECT count(*) * 2 + 7 FROM documents)', '')}")
def mix_proportional(spark, sf):
    docs = _by_lang(spark, sf)
    return mx.mix(docs, "proportional", docs.count() * 2 + 7)


@query("mix_equal", f"WITH {_sized('1')} {_mix_sql('(SELECT count(*) FROM documents)', '')}")
def mix_equal(spark, sf):
    return mx.mix(_by_lang(spark, sf), "equal")


@query("mix_custom", f"WITH {_sized(WEIGHT_CASE)} {_mix_sql('(SELECT count(*) FROM documents)', '')}")
def mix_custom(spark, sf):
    return mx.mix(_by_lang(spark, sf), "custom", weights=WEIGHTS)


INTERLEAVE = """SELECT row_id, dataset, row_number() OVER (ORDER BY rn, dataset) - 1 AS position FROM (
  SELECT doc_id AS row_id, lang AS dataset, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents)"""


@query("interleave", INTERLEAVE)
def interleave(spark, sf):
    return mx.interleave(_by_lang(spark, sf))


@query(
    "interleave_shortest",
    INTERLEAVE + " WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang))",
)
def interleave_shortest(spark, sf):
    return mx.interleave(_by_lang(spark, sf), stop_on_shortest=True)


def _stage_sql(stage: int, start: int, rows: int, weight: str) -> str:
    return f"""SELECT {stage} AS stage, {start} AS first, row_id, dataset, copy FROM (
      WITH {_sized(weight, 42 + stage)} {_mix_sql(str(rows), '')})"""


@query(
    "curriculum",
    f"""WITH drawn AS ({_stage_sql(0, 0, 100 * 4, "CASE lang WHEN 'en' THEN 1.0 ELSE 0.0 END")}
      UNION ALL {_stage_sql(1, 100, 60 * 4, "CASE lang WHEN 'en' THEN 0.5 WHEN 'de' THEN 0.5 ELSE 0.0 END")})
    SELECT row_id, dataset, copy, CAST(stage AS INT) AS stage, first + (row_number() OVER (PARTITION BY stage ORDER BY
      md5('42:' || stage || ':' || row_id || ':' || copy), row_id, copy) - 1) // 4 AS step FROM drawn""",
)
def curriculum(spark, sf):
    plan = [(0, {"en": 1.0}), (100, {"en": 0.5, "de": 0.5})]
    return mx.curriculum(_by_lang(spark, sf), plan, 160, 4)


@query(
    "union_datasets",
    f"""WITH {DOC_RECORDS}, {PAIRS}, local AS (SELECT 'src1' AS dataset, row_id, instruction FROM pairs)
    SELECT dataset, row_id, instruction FROM doc_records WHERE dataset NOT IN (SELECT dataset FROM local)
    UNION ALL SELECT dataset, row_id, instruction FROM local""",
)
def union_datasets(spark, sf):
    local = pairs(spark, sf).withColumn("dataset", F.lit("src1"))
    return mx.union_datasets(doc_records(spark, sf), local).select("dataset", "row_id", "instruction")


@query("shuffle", f"SELECT doc_id AS row_id, row_number() OVER (ORDER BY {sql_key(7, 'doc_id')}, doc_id) - 1 AS position FROM documents")
def shuffle(spark, sf):
    return sp.shuffle(_ids(spark, sf).select("row_id"), 7)


@query(
    "sample_by_label",
    f"""SELECT row_id, lang FROM (SELECT doc_id AS row_id, lang,
    row_number() OVER (PARTITION BY lang ORDER BY {sql_key(42, 'doc_id')}, doc_id) AS rn FROM documents) WHERE rn <= 15""",
)
def sample_by_label(spark, sf):
    return sp.sample_by_label(_ids(spark, sf), "lang", 15).select("row_id", "lang")


@query(
    "row_numbers",
    "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events",
)
def row_numbers(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return scan(events, ["user_id"], ["ts", "event_id"], RowNumber("rn")).drop("ts")


# --- null groups -------------------------------------------------------------

#: the language with one of them unknown: a group of its own
UNKNOWN = "CASE WHEN lang = 'fr' THEN NULL ELSE lang END"


def _unknown(spark, sf):
    lang = F.when(F.col("lang") != "fr", F.col("lang"))
    return table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), lang.alias("dataset"))


def _numbered(order: str) -> str:
    return f"""SELECT row_id, dataset, row_number() OVER (PARTITION BY dataset ORDER BY {order}) AS rn, count(*) OVER (PARTITION BY dataset) AS n
      FROM (SELECT doc_id AS row_id, {UNKNOWN} AS dataset FROM documents)"""


BY_KEY = _numbered("md5('42:' || row_id), row_id")


@query(
    "split_stratified_null",
    f"""SELECT row_id, dataset, CASE WHEN rn <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train'
      WHEN rn <= floor(n * CAST(0.9 AS DOUBLE)) THEN 'validation' ELSE 'test' END AS split FROM ({BY_KEY})""",
)
def split_stratified_null(spark, sf):
    return sp.split_stratified(_unknown(spark, sf), "dataset", RATIOS)


@query("sample_by_label_null", f"SELECT row_id, dataset FROM ({BY_KEY}) WHERE rn <= 15")
def sample_by_label_null(spark, sf):
    return sp.sample_by_label(_unknown(spark, sf), "dataset", 15)


@query(
    "mix_equal_null",
    f"""WITH numbered AS ({BY_KEY}), wanted AS (
      SELECT *, CAST(floor(CAST((SELECT count(*) FROM documents) AS DOUBLE) / (SELECT count(*) FROM (SELECT DISTINCT dataset FROM numbered))) AS BIGINT) AS target FROM numbered)
    SELECT row_id, dataset, unnest(range(1, target // n + CASE WHEN rn <= target % n THEN 2 ELSE 1 END)) AS copy FROM wanted""",
)
def mix_equal_null(spark, sf):
    return mx.mix(_unknown(spark, sf), "equal")


@query(
    "mix_custom_null",
    f"""WITH weights(dataset, w) AS (VALUES (NULL, 3.0), ('en', 1.0)), numbered AS ({BY_KEY}), wanted AS (
      SELECT r.*, CAST(floor(500 * CAST(w AS DOUBLE) / 4) AS BIGINT) AS target FROM numbered r JOIN weights x ON x.dataset IS NOT DISTINCT FROM r.dataset)
    SELECT row_id, dataset, unnest(range(1, target // n + CASE WHEN rn <= target % n THEN 2 ELSE 1 END)) AS copy FROM wanted""",
)
def mix_custom_null(spark, sf):
    return mx.mix(_unknown(spark, sf), "custom", 500, {None: 3.0, "en": 1.0})


@query("interleave_null", f"SELECT row_id, dataset, row_number() OVER (ORDER BY rn, dataset NULLS FIRST) - 1 AS position FROM ({_numbered('row_id')})")
def interleave_null(spark, sf):
    return mx.interleave(_unknown(spark, sf))


@query("head_n_null", f"SELECT row_id, dataset FROM ({_numbered('row_id')}) WHERE rn <= 7")
def head_n_null(spark, sf):
    return sp.head_n(_unknown(spark, sf), 7)
