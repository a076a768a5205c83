"""String expressions. All of them are plain Spark columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and str.split() treat as white space.
SPACE = r"\x09-\x0d\x1c-\x20\x85\p{Z}"
# Fixed value: ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PUNCTUATION_CLASS = r"[!-/:-@\[-`{-~]"

SEPARATOR = "\x1f"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """White space removed at both ends, by Python's notion of white space."""
    return F.regexp_replace(_col(c), rf"^[{SPACE}]+|[{SPACE}]+\z", "")


def remove_tags(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), r"<[^>]+>", "")


def is_blank(c: str | Column) -> Column:
    return ~_col(c).rlike(rf"[^{SPACE}]")


def words(c: str | Column) -> Column:
    """White-space separated tokens; an empty array for null."""
    found = F.regexp_extract_all(_col(c), F.lit(rf"[^{SPACE}]+"), 0)
    return F.coalesce(found, F.array().cast("array<string>"))


def word_count(c: str | Column) -> Column:
    return F.coalesce(F.regexp_count(_col(c), F.lit(rf"[^{SPACE}]+")), F.lit(0))


def alnum_words(c: str | Column) -> Column:
    """Lower-cased runs of ASCII letters and digits."""
    found = F.regexp_extract_all(F.lower(_col(c)), F.lit("[a-z0-9]+"), 0)
    return F.coalesce(found, F.array().cast("array<string>"))


def chars(c: str | Column) -> Column:
    """The characters of a text without white space."""
    found = F.regexp_extract_all(_col(c), F.lit(rf"[^{SPACE}]"), 0)
    return F.coalesce(found, F.array().cast("array<string>"))


def without_space(c: str | Column) -> Column:
    """A text without white space."""
    return F.regexp_replace(_col(c), rf"[{SPACE}]+", "")


def metric_words(c: str | Column) -> Column:
    """Words with one leading or trailing punctuation mark split off."""

    def split_mark(t: Column) -> Column:
        n = F.length(t)
        return (
            F.when(n == 1, F.array(t))
            .when(t.rlike(PUNCTUATION_CLASS + r"\z"), F.array(t.substr(F.lit(1), n - 1), F.right(t, F.lit(1))))
            .when(t.rlike("^" + PUNCTUATION_CLASS), F.array(F.left(t, F.lit(1)), t.substr(F.lit(2), n - 1)))
            .otherwise(F.array(t))
        )

    return F.flatten(F.transform(words(c), split_mark))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once per row.

    A column used inside a lambda would be evaluated again for every element.
    """
    return F.transform(F.array(value), body)[0]


def _runs(tokens: Column, n: int, joiner: str) -> Column:
    if n == 1:
        return tokens
    last = F.size(tokens) - n
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        # single elements, because a slice copies the whole array for every run
        lambda i: F.concat_ws(joiner, *[F.get(tokens, i + j) for j in range(n)]),
    )
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<string>"))


def ngrams(tokens: Column, n: int, joiner: str = SEPARATOR) -> Column:
    """All runs of n tokens, joined to strings; empty when there are fewer tokens."""
    return let(tokens, lambda t: _runs(t, n, joiner))


def ngrams_up_to(tokens: Column, max_n: int, joiner: str = SEPARATOR) -> Column:
    """Runs of 1..max_n tokens as structs ``(n, gram)`` in one array."""

    def labelled(t: Column, n: int) -> Column:
        return F.transform(_runs(t, n, joiner), lambda g: F.struct(F.lit(n).alias("n"), g.alias("gram")))

    return let(tokens, lambda t: F.concat(*[labelled(t, n) for n in range(1, max_n + 1)]))


def truncate_text(c: str | Column, size: int, suffix: str = "...") -> Column:
    """At most ``size`` characters, the suffix included when something was cut."""
    text = _col(c)
    kept = F.concat(F.substring(text, 1, max(size - len(suffix), 0)), F.lit(suffix))
    return F.when(F.length(text) <= size, text).otherwise(kept)


def chunk_text(c: str | Column, size: int, overlap: int = 0, separator: str = " ") -> Column:
    """Windows of ``size`` words, ``overlap`` shared, up to the one that reaches the end."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below the chunk size")
    step = size - overlap

    def windows(parts: Column) -> Column:
        # the first window whose end is at or past the last word is the last one
        extra = F.greatest(F.lit(0), F.ceil((F.size(parts) - size) / step)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), extra),
            lambda i: F.array_join(F.slice(parts, i * step + 1, size), separator),
        )

    return let(F.split(_col(c), r"\Q" + separator + r"\E", -1), windows)


def normalize_answer(
    c: str | Column, ignore_case: bool = True, ignore_punctuation: bool = True, ignore_numbers: bool = False
) -> Column:
    """An answer reduced to what counts when comparing."""
    text = _col(c)
    if ignore_case:
        text = F.lower(text)
    if ignore_punctuation:
        text = F.regexp_replace(text, PUNCTUATION_CLASS, "")
    if ignore_numbers:
        text = F.regexp_replace(text, "[0-9]", "")
    return strip(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def compose(*steps):
    """Column functions applied from left to right."""
    return lambda c: reduce(lambda acc, f: f(acc), steps, c)
