"""Language by character trigrams: a profile learned from labelled texts, and its scores.

A text's trigrams are those of its letters in lower case, each word with a space on either side. A
profile holds, for each language, its ``size`` most frequent trigrams with a whole number of
thousandths of their log probability, and one for all others. Scores are sums of such numbers, so they
do not depend on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.batches import pieces
from tablewright.functions.language import lower_words
from tablewright.functions.text import let
from tablewright.operators.sized import small_table
from tablewright.session import durable

PROFILE_SIZE = 500
WIDTH = 3
OTHER = ""
#: a profile of more rows is joined instead of sent to the tasks
PROFILE_ROWS = 200_000
# a trigram's number has its three code points in order, so numbers compare as the texts do
_BITS, _LAST = 21, (1 << 21) - 1


def trigrams(text: Column) -> Column:
    """The trigrams of a text with repeats; null and letterless texts have none."""

    def of_word(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        # words are short: a place in a whole text would be searched for from its start
        return let(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - (WIDTH - 1)), lambda i: F.substring(p, i, F.lit(WIDTH))))

    return F.flatten(F.transform(lower_words(text), of_word))


def _spaced(text: Column) -> Column:
    """The words that ``trigrams`` takes, between spaces: a trigram stands around each letter."""
    words = F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")
    return F.concat(F.lit(" "), F.coalesce(words, F.lit("")), F.lit(" "))


def _numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every trigram of spaced texts."""
    points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), pc.utf8_length(texts).to_numpy())
    at = np.flatnonzero(points != ord(" "))
    return rows[at], points[at - 1] << 2 * _BITS | points[at] << _BITS | points[at + 1]


def _number(gram: str) -> int:
    a, b, c = map(ord, gram)
    return a << 2 * _BITS | b << _BITS | c


@F.arrow_udf(T.StringType())
def _gram(numbers: pa.Array) -> pa.Array:
    return pa.array([chr(x >> 2 * _BITS) + chr(x >> _BITS & _LAST) + chr(x & _LAST) for x in numbers.to_pylist()], pa.string())


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pieces(batch, pc.utf8_length(batch.column("_text")).to_numpy())


def learn_profiles(df: DataFrame, text: str, label: str, size: int = PROFILE_SIZE) -> DataFrame:
    """(lang, gram, points) from labelled texts: ``size`` rows and one for other trigrams per language.

    With n the occurrences of a trigram, N all of the language and V its distinct trigrams, a trigram has
    floor(1000 ln((n + 1) / (N + V + 1))) points; others have those of n = 0. Tasks count the trigrams of
    some texts together, so only a row for each of these counts is shuffled.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            rows, numbers = _numbered(part.column("_text"))
            labels = part.column("lang").dictionary_encode()
            found = pa.table({"label": labels.indices.take(pa.array(rows)), "gram": pa.array(numbers)}).group_by(["label", "gram"]).aggregate([([], "count_all")])
            found = found.combine_chunks()
            columns = [labels.dictionary.take(found["label"]), found["gram"], found["count_all"]]
            yield from pa.table(columns, ["lang", "_gram", "n"]).to_batches()

    labelled = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("lang"), _spaced(F.col(text)).alias("_text"))
    schema = T.StructType([labelled.schema["lang"], T.StructField("_gram", T.LongType()), T.StructField("n", T.LongType())])
    counts = labelled.mapInArrow(counted, schema).groupBy("lang", "_gram").agg(F.sum("n").alias("n"))
    counts = durable(counts)
    totals = counts.groupBy("lang").agg((F.sum("n") + F.count(F.lit(1)) + 1).alias("_all"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col("_gram").asc())
    top = counts.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= size).select("lang", _gram("_gram").alias("gram"), "n")
    top = top.unionByName(totals.select("lang", F.lit(OTHER).alias("gram"), F.lit(0).cast("long").alias("n")))
    points = F.floor(1000 * F.log((F.col("n") + 1) / F.col("_all").cast("double"))).cast("long")
    return top.join(F.broadcast(totals), "lang").select("lang", "gram", points.alias("points"))


def profile_scores(df: DataFrame, text: str, profiles: DataFrame, row_id: str = "row_id") -> DataFrame:
    """(row_id, lang, points): every text against every language.

    A profile has ``size`` + 1 rows for each language, which are few: tasks get them whole, and a row for
    each text and language leaves them. A larger one is joined with the trigrams of the texts.
    """
    profiles = profiles.select("lang", "gram", "points")
    table = small_table(profiles, PROFILE_ROWS)
    if table is None:
        return _joined_scores(df, text, profiles, row_id)
    shared = df.sparkSession.sparkContext.broadcast(table)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value.to_pylist()
        other = {x["lang"]: x["points"] for x in held if x["gram"] == OTHER}
        place = {lang: i for i, lang in enumerate(other)}
        langs = pa.array(list(other), shared.value.schema.field("lang").type)
        rest = np.array(list(other.values()), np.int64)
        known = [(_number(x["gram"]), place[x["lang"]], x["points"]) for x in held if len(x["gram"]) == WIDTH and x["lang"] in place]
        numbers = np.unique(np.array([x[0] for x in known], np.int64))
        gains = np.tile(rest, (len(numbers) + 1, 1))  # the last row is that of all others
        for number, lang, points in known:
            gains[np.searchsorted(numbers, number), lang] = points
        numbers = np.append(numbers, np.int64(1) << 62)
        for part in _parts(batches):
            rows, found = _numbered(part.column("_text"))
            at = np.searchsorted(numbers, found)
            at[numbers[at] != found] = len(numbers) - 1
            some = np.flatnonzero(np.bincount(rows, minlength=part.num_rows))
            # whole numbers far below 2^53, so sums in doubles are exact
            sums = [np.bincount(rows, gains[at, i], part.num_rows)[some].astype(np.int64) for i in range(len(rest))]
            for i, s in enumerate(sums):
                columns = [part.column(row_id).take(pa.array(some)), pa.array(np.full(len(some), i)), pa.array(s)]
                yield pa.RecordBatch.from_arrays([columns[0], langs.take(columns[1]), columns[2]], [row_id, "lang", "points"])

    texts = df.select(row_id, _spaced(F.col(text)).alias("_text"))
    schema = T.StructType([texts.schema[row_id], profiles.schema["lang"], T.StructField("points", T.LongType())])
    return texts.mapInArrow(scored, schema).groupBy(row_id, "lang").agg(F.sum("points").alias("points"))


def _joined_scores(df: DataFrame, text: str, profiles: DataFrame, row_id: str) -> DataFrame:
    """Trigrams of a text are counted before they meet the profiles, one row for each trigram."""
    spread = profiles.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "points"))).alias("_known"))
    base = profiles.filter(F.col("gram") == OTHER).select("lang", F.col("points").alias("_other"))
    every = base.agg(F.collect_list(F.struct("lang", "_other")).alias("_langs"))
    counted = df.select(row_id, F.explode(trigrams(F.col(text))).alias("gram")).groupBy(row_id, "gram").agg(F.count(F.lit(1)).alias("_n"))
    met = counted.join(spread, "gram", "left").withColumn("_langs", every.scalar())
    gains = F.transform("_langs", lambda x: F.struct(x["lang"].alias("lang"), F.coalesce(F.try_element_at("_known", x["lang"]), x["_other"]).alias("points")))
    scored = met.select(row_id, "_n", F.inline(gains))
    return scored.groupBy(row_id, "lang").agg(F.sum(F.col("points") * F.col("_n")).alias("points"))


def profiled_language(df: DataFrame, text: str, profiles: DataFrame, row_id: str = "row_id", unknown: str = "und") -> DataFrame:
    """(row_id, detected): the language with most points, the first by name among equals; ``unknown`` for
    texts without letters."""
    best = F.min_by("lang", F.struct(-F.col("points"), F.col("lang")))
    found = profile_scores(df, text, profiles, row_id).groupBy(row_id).agg(best.alias("detected"))
    return df.select(row_id).join(found, row_id, "left").select(row_id, F.coalesce("detected", F.lit(unknown)).alias("detected"))


def expected_languages(detected: DataFrame, expected: Sequence[str], column: str = "detected") -> DataFrame:
    """Rows by language, with whether it is expected; expected languages that do not occur have 0 rows."""
    spark = detected.sparkSession
    wanted = spark.createDataFrame([(x,) for x in expected], "lang string").distinct().withColumn("expected", F.lit(True))
    counts = detected.groupBy(F.col(column).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    both = counts.join(F.broadcast(wanted), "lang", "full")
    n = F.coalesce("n", F.lit(0).cast("long"))
    known = F.coalesce("expected", F.lit(False))
    status = F.when(n == 0, "missing").when(known, "present").otherwise("unexpected")
    return both.select("lang", n.alias("n"), known.alias("expected"), status.alias("status"))
