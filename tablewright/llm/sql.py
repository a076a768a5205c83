"""The results of operators as DuckDB SQL, where SQL can state them."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(text: str) -> str:
    """A text, null as empty, with A-Z made a-z."""
    return f"translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}')"


def alnum_words(text: str) -> str:
    return f"regexp_extract_all({lowered(text)}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"


def plain_words(text: str) -> str:
    return f"regexp_extract_all({text}, '[^\\x09-\\x0D\\x20]+')"


def letter_words(text: str) -> str:
    return f"regexp_extract_all({lowered(text)}, '[a-z\\x{{80}}-\\x{{10FFFF}}]+')"


#: checksums of distinct features by the table of the bytes, 256 steps by rule
RESAMPLE = f"""
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
words AS (
  SELECT 'd' AS side, doc_id AS id, {alnum_words('text')} AS w FROM documents
  UNION ALL SELECT 'b', item_id, {alnum_words('text')} FROM benchmark),
features AS (
  SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
counted AS (SELECT side, id, f, count(*) AS n FROM features GROUP BY ALL),
bytes AS (
  SELECT f, list_transform(range(octet_length(encode(f))), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT) AS b
  FROM (SELECT DISTINCT f FROM counted)),
buckets AS (
  SELECT f, xor(4294967295, list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 10000 AS bucket
  FROM bytes, tab),
placed AS (SELECT side, id, bucket, n FROM counted JOIN buckets USING (f)),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t
  FROM placed GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000))))::BIGINT AS gain FROM sums, totals),
weights AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS total FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features,
    coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
    ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h
  FROM documents LEFT JOIN weights ON doc_id = id),
final AS (
  SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score,
    n_features >= 39 AS able FROM scored),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) FILTER (able) OVER () AS fit FROM final)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * fit // 100 THEN place END AS rank FROM ordered
"""

DIVERGENCE = f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {letter_words('text')} AS w FROM documents),
numbered AS (SELECT row_number() OVER () AS id, * FROM docs),
tokens AS (SELECT id, lang, source, unnest(w) AS term FROM numbered),
kept AS (SELECT lang, term FROM tokens GROUP BY ALL HAVING count(DISTINCT id) >= 30),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
cells AS (SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (coalesce(s.total, 0)::HUGEINT + 5 * v))::BIGINT AS p
  FROM groups g JOIN kept k USING (lang) JOIN vocabulary USING (lang) LEFT JOIN totals s USING (lang, source) LEFT JOIN cells c USING (lang, source, term)),
whole AS (
  SELECT lang, term, (1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER (PARTITION BY lang)::HUGEINT + 5 * v))::BIGINT AS q
  FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL) JOIN vocabulary USING (lang)),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM dense JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

JACCARD = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {plain_words(lowered('text'))} AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM docs),
texts AS (SELECT doc_id, unnest(s) AS t, len(s) AS n FROM sets),
numbers AS (SELECT t, row_number() OVER () AS x FROM (SELECT DISTINCT t FROM texts)),
shingles AS (SELECT doc_id, x, n FROM texts JOIN numbers USING (t)),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS common FROM shingles a
  JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY ALL),
pairs AS (SELECT a, b FROM shared WHERE 100 * common >= 85 * (n + m - common)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT doc_id, any_value(len(s))::BIGINT AS n_shingles, min(other) AS component_id FROM reached JOIN sets USING (doc_id) GROUP BY doc_id
"""

REPEATS = f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, {plain_words("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT id, doc_id, unnest(range(1, len(w) - 48)) AS pos,
    unnest(list_transform(range(1, len(w) - 48), lambda i: array_to_string(w[i:i + 49], ' '))) AS window_text FROM docs WHERE len(w) >= 50),
again AS (SELECT id, pos FROM (SELECT id, pos, doc_id, min(doc_id) OVER (PARTITION BY window_text) AS first FROM windows) WHERE first < doc_id),
gone AS (SELECT DISTINCT id, pos + k AS place FROM again, range(50) r(k)),
places AS (SELECT id, list(place) AS p FROM gone GROUP BY id),
marked AS (SELECT doc_id, w, coalesce(p, []) AS p FROM docs LEFT JOIN places USING (id))
SELECT doc_id, len(w)::BIGINT AS n_words, len(p)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN len(p) = 0 THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(p, i)) END, ' ')) AS kept_sha256 FROM marked
"""

CONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, {alnum_words('text')} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {alnum_words('text')} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS width,
    unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS gram
  FROM items WHERE len(w) > 0),
widths AS (SELECT DISTINCT width FROM windows),
grams AS (
  SELECT id, width, unnest(range(1, len(w) - width + 2)) AS pos, unnest(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' '))) AS gram
  FROM docs, widths WHERE len(w) >= width),
found AS (SELECT id, pos, width, item FROM grams JOIN windows USING (width, gram)),
hit AS (SELECT id, count(DISTINCT place) AS n FROM (SELECT id, unnest(range(pos, pos + width)) AS place FROM (SELECT DISTINCT id, pos, width FROM found)) GROUP BY id),
names AS (SELECT id, count(DISTINCT item) AS n_items, list_sort(list(DISTINCT item)) AS names FROM found GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(array_to_string(coalesce(names, []), ',')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (id) LEFT JOIN names USING (id)
"""

QUALITY_BASE = f"""
WITH docs AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text, {plain_words("coalesce(text, '')")} AS w FROM documents),
grams AS (
  SELECT id, unnest(range(1, len(w) - 6)) AS pos, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS gram FROM docs WHERE len(w) >= 8),
again AS (SELECT id, pos FROM (SELECT id, pos, count(*) OVER (PARTITION BY id, gram) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT id, count(DISTINCT pos + k) AS n FROM again, range(8) r(k) GROUP BY id),
lines AS (SELECT id, unnest(string_split(text, chr(10))) AS line FROM docs),
doubles AS (SELECT id, sum(n - 1) AS n FROM (SELECT id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\\x09-\\x0D\\x20]') GROUP BY ALL) GROUP BY id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
  len(w) < 20 OR 100 * coalesce(r.n, 0) > 30 * len(w) AS base_failed
FROM docs LEFT JOIN repeated r USING (id) LEFT JOIN doubles d USING (id)
"""

SHARD_SIZES = """
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
coded AS (SELECT text, hex(encode(text)) AS h FROM texts),
bytes AS (SELECT text, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b FROM coded),
sums AS (SELECT text, xor(4294967295, list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS crc FROM bytes, tab)
SELECT doc_id, (octet_length(encode(coalesce(d.text, ''))) + 1)::BIGINT AS size, crc::BIGINT AS text_crc32
FROM documents d JOIN sums ON sums.text = coalesce(d.text, '')
"""
