"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit
per failed rule; policies, which are versioned sets of rules, and ablations are bit
operations on the stored ledger and never read a text again.

Words are `[^\\x20\\x09-\\x0D]+`. Null and empty texts have no words and fail `few_words`.
Repeated rows each get their own result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.textkit import PLAIN, Runs, buffer_of, byte_class, covered, grouped, mix, slices, sums, window_hashes, window_starts

WINDOW = 8
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
NOT_LINE_END = ~byte_class([(0x0A, 0x0A)])
FIRST_OF_CHAR = ~byte_class([(0x80, 0xBF)])
UPPER = byte_class([(0x41, 0x5A)])
LETTER = byte_class([(0x41, 0x5A), (0x61, 0x7A)])
BANG = byte_class([(0x21, 0x21)])
DIGIT = byte_class([(0x30, 0x39)])

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_bangs", "n_digits", "n_twins",
)

LEDGER = "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)


def _c(name: str) -> Column:
    return F.col(name)


#: rule name -> condition of failure. The position is the bit; rules are only ever added.
RULES: dict[str, Callable[[], Column]] = {
    "few_words": lambda: _c("n_words") < 20,
    "repeated_windows": lambda: 100 * _c("n_repeat_words") > 30 * _c("n_words"),
    "symbols": lambda: 100 * _c("n_symbols") > 6 * _c("word_chars"),
    "shouting": lambda: (100 * _c("n_upper") > 40 * _c("n_letters")) & (_c("n_letters") >= 20),
    "bangs": lambda: 100 * _c("n_bangs") > 20 * _c("n_words"),
    "twin_words": lambda: 100 * _c("n_twins") > 20 * _c("n_words"),
    "repeated_lines": lambda: (100 * _c("n_dup_lines") > 60 * _c("n_lines")) & (_c("n_dup_lines") >= 5),
    "digits": lambda: 100 * _c("n_digits") > 40 * _c("word_chars"),
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}

#: policies never change once published; a new one gets a new name
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_windows"),
    "full-1": tuple(RULES),
}
BASE, CURRENT = "base-1", "full-1"


def mask_of(policy: str) -> int:
    return sum(BIT[rule] for rule in POLICIES[policy])


def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
    """All measurements of a batch with columns doc_id and text."""
    data, offs = buffer_of(batch.column("text"))
    words = Runs(data, offs, PLAIN)
    lines = Runs(data, offs, NOT_LINE_END)
    n = len(offs) - 1
    hashes = words.hashes()

    has_word = np.diff(np.concatenate(([0], np.cumsum(words.inside)))[np.stack((lines.starts, lines.ends))], axis=0)[0] > 0
    rows = lines.row[has_word]
    key = mix(lines.hashes()[has_word] + mix(rows.astype(np.uint64)))
    order, new = grouped(key)
    dup_lines = np.bincount(rows[order][~new], minlength=n)

    starts = window_starts(words, WINDOW)
    windows = window_hashes(hashes, WINDOW)[starts] if len(starts) else np.zeros(0, np.uint64)
    order, new = grouped(mix(windows + mix(words.row[starts].astype(np.uint64))))
    twice = ~new
    twice[:-1] |= ~new[1:]
    repeated = covered(starts[order][twice], WINDOW, len(words))
    per_text = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[words.first])
    twin = np.zeros(len(words), bool)
    twin[1:] = (hashes[1:] == hashes[:-1]) & (words.row[1:] == words.row[:-1])

    found = {
        "n_words": words.counts,
        "word_chars": sums(words.inside & FIRST_OF_CHAR[data], offs),
        "n_symbols": sums(SYMBOLS[data], offs),
        "n_dup_lines": dup_lines,
        "n_repeat_words": per_text(repeated),
        "n_lines": np.bincount(rows, minlength=n),
        "n_upper": sums(UPPER[data], offs),
        "n_letters": sums(LETTER[data], offs),
        "n_bangs": sums(BANG[data], offs),
        "n_digits": sums(DIGIT[data], offs),
        "n_twins": per_text(twin),
    }
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[m], pa.int64()) for m in MEASURES)], ["doc_id", *MEASURES])


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and `failed`, the bits of the failed rules."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                yield measure(piece)

    bits = sum((F.when(rule(), F.lit(BIT[name])).otherwise(F.lit(0)) for name, rule in RULES.items()), F.lit(0))
    return docs.select("doc_id", "text").mapInArrow(run, LEDGER).withColumn("failed", bits.cast("bigint"))


def passes(policy: str, failed: str = "failed") -> Column:
    """Whether a ledger row breaks no rule of the policy."""
    return F.col(failed).bitwiseAND(F.lit(mask_of(policy))) == 0


def ablations(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: rows that fail it, rows that fail only it (and would be
    kept without it), and rows that the policy keeps. Distinct bit sets are counted first,
    of which there are few, so no row is looked at twice."""
    sets = entries.groupBy("failed").agg(F.count("*").alias("rows"))
    mask = mask_of(policy)
    each = sets.select("failed", "rows", F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit")) for r in POLICIES[policy]])).alias("x"))
    hit = F.col("failed").bitwiseAND(F.col("x.bit")) != 0
    only = F.col("failed").bitwiseAND(F.lit(mask)) == F.col("x.bit")
    return each.groupBy(F.col("x.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("rows")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(only, F.col("rows")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("failed").bitwiseAND(F.lit(mask)) == 0, F.col("rows")).otherwise(0)).alias("n_kept"),
    )


def verdicts(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The contract's columns, with the failure bits."""
    base = ~passes(BASE)
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & passes(policy)).alias("kept"), "failed",
    )
