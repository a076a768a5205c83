"""Language guess by stop words, as a row-local expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.text import let

# Frequent function words of each language.
STOP_WORDS: dict[str, tuple[str, ...]] = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "zu", "mit", "von", "den", "auf", "für", "auch"),
    "en": ("the", "of", "and", "to", "that", "is", "it", "for", "was", "on", "with", "as", "are", "this"),
    "es": ("el", "los", "las", "que", "y", "por", "con", "una", "del", "para", "se", "como", "su", "al"),
    "fr": ("le", "les", "des", "et", "une", "que", "dans", "pour", "qui", "est", "pas", "sur", "du", "avec"),
}


def _hits(tokens: Column, lang: str) -> Column:
    return F.size(F.filter(tokens, lambda t: t.isin(*STOP_WORDS[lang])))


def lower_words(c: Column) -> Column:
    found = F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}]+"), 0)
    return F.coalesce(found, F.array().cast("array<string>"))


def detect_language(c: str | Column, unknown: str = "und") -> Column:
    """The language with most stop words; ties go to the alphabetically last one."""
    text = F.col(c) if isinstance(c, str) else c

    def best(tokens: Column) -> Column:
        scores = [F.struct(_hits(tokens, lang).alias("n"), F.lit(lang).alias("lang")) for lang in sorted(STOP_WORDS)]
        return F.array_max(F.array(*scores))

    winner = let(lower_words(text), best)
    return let(winner, lambda w: F.when(w["n"] > 0, w["lang"]).otherwise(F.lit(unknown)))
