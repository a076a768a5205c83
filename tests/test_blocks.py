"""N-grams that meet in passes: whole results, and no shuffle files that stay behind."""

from __future__ import annotations

import math
import os
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tablewright.functions import packed as pk
from tablewright.operators import bigrams as bg
from tablewright.operators import blocks as bl
from tablewright.operators import overlap as ov
from tablewright.operators import scores as sc
from tablewright.plans import catalog


def made_rows(n, words=40, seed=5):
    rng = random.Random(seed)
    vocabulary = ["é", "a", "the", *(f"w{i}" for i in range(words))]
    return [(i, rng.choice([None, "x", "y"]), " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30)))) for i in range(n)]


def shuffled_bytes(spark):
    """Bytes of the shuffle files that a local session holds."""
    found = 0
    for top in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs():
        for folder, _, names in os.walk(str(top)):
            found += sum(os.path.getsize(os.path.join(folder, x)) for x in names if x.startswith("shuffle_") and x.endswith(".data"))
    return found


def left_behind(spark, work):
    """Bytes of shuffle files that ``work`` adds for good."""
    before = shuffled_bytes(spark)
    work()
    for _ in range(40):
        if (more := shuffled_bytes(spark) - before) < 100_000:
            break
        time.sleep(0.25)
    return more


def test_packed_arrays_come_back():
    for numbers in ([], [0], [1, 255, 256], [7, 1 << 40], [-1, 3]):
        assert pk.unpacked_numbers(pk.packed_numbers(np.array(numbers, np.int64))).tolist() == numbers
    for words in ([], ["a"], ["é", "中文", "x\x00y", "a"]):
        assert pk.unpacked_words(pk.packed_words(pa.array(words, pa.string()))).to_pylist() == words


def test_keys_with_equal_halves_are_told_apart():
    h1 = np.array([5, 5, 5, 9, 5, 5], np.uint64)
    h2 = np.array([1, 2, 1, 1, 2, 3], np.uint64)
    order, new = pk.sorted_keys(h1, h2)
    assert sorted(zip(h1[order[new]].tolist(), h2[order[new]].tolist())) == [(5, 1), (5, 2), (5, 3), (9, 1)]
    assert pk.sorted_keys(h1, h2, np.array([0, 0, 1, 0, 0, 0]))[1].sum() == 5
    at = pk.found_at(h1[order], h2[order], *(np.array(x, np.uint64) for x in ([5, 5, 9, 4, 10], [3, 9, 1, 1, 1])))
    assert [h2[order][i] if i >= 0 else None for i in at] == [3, None, 1, None, None]
    assert len(pk.sorted_keys(h1[:0], h2[:0])[0]) == 0 and pk.found_at(h1[:0], h2[:0], h1, h2).tolist() == [-1] * 6


@pytest.mark.parametrize("gathered", [50, 1 << 21])
def test_distinct_ngrams_of_all_passes(spark, monkeypatch, gathered):
    monkeypatch.setattr(bl, "GATHERED", gathered)
    monkeypatch.setattr(bl, "PART", 8 * gathered)
    rows = made_rows(300) + [(900, "z", None), (901, "z", " "), (902, "only", "a b")]
    df = spark.createDataFrame(rows, "row_id long, lang string, t string")
    want = defaultdict(Counter)
    for _, lang, t in rows:
        w = (t or "").split()
        for n in (1, 2, 3):
            want[lang, n].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    got = {(r.lang, r.n): (r.unique_ngrams, r.total_ngrams) for r in ov.distinct_n(df, "t", ["lang"], (1, 2, 3)).collect()}
    assert got == {k: (len(c), sum(c.values())) for k, c in want.items() if c}
    whole = ov.distinct_n(df, "t", [], (2,)).first()
    assert whole.unique_ngrams == len(set().union(*(c for (_, n), c in want.items() if n == 2)))


def test_distinct_ngrams_leave_no_shuffle_files(spark):
    df = spark.createDataFrame(made_rows(20_000, 50_000), "row_id long, lang string, t string").cache()
    df.count()
    assert left_behind(spark, lambda: ov.distinct_n(df, "t", ["lang"]).collect()) < 100_000
    df.unpersist()


def scores_by_hand(rows, fitted, k, vocabulary):
    """row_id -> (perplexity, pairs) from plain counts."""
    pairs, firsts = Counter(), Counter()
    for _, _, t in fitted:
        w = (t or "").split()
        pairs.update(zip(w, w[1:]))
        firsts.update(w[:-1])
    logs = defaultdict(list)
    for i, _, t in rows:
        w = (t or "").split()
        logs[i] += [math.log((pairs[p] + k) / (firsts[p[0]] + k * vocabulary)) for p in zip(w, w[1:])]
    return pairs, firsts, {i: (math.exp(-sum(x) / len(x)), len(x)) for i, x in logs.items() if x}


@pytest.mark.parametrize(("gathered", "hot"), [(50, 3), (1 << 21, 1000)])
def test_bigrams_of_all_passes(spark, monkeypatch, gathered, hot):
    monkeypatch.setattr(bl, "GATHERED", gathered)
    monkeypatch.setattr(bl, "PART", 8 * gathered)
    monkeypatch.setattr(bg, "HOT_LEAST", hot)
    fitted = made_rows(200) + [(0, "x", "the a the a"), (500, None, None), (501, None, "alone")]
    new = [*fitted, (None, "x", "the unknown w1 a"), (777, "x", "unknown unknown")]
    schema = "row_id long, lang string, t string"
    model = sc.ngram_lm_fit(spark.createDataFrame(fitted, schema), "t")
    pairs, firsts, want = scores_by_hand(new, fitted, 0.5, 43)
    assert {(r.prev, r.word): (r.n, r.n_prev) for r in model.collect()} == {p: (n, firsts[p[0]]) for p, n in pairs.items()}
    got = sc.ngram_lm_score(spark.createDataFrame(new, schema), "t", model, 43, k=0.5).collect()
    assert len(got) == len(want)
    for r in got:
        assert (r.perplexity, r.n_bigrams) == (pytest.approx(want[r.row_id][0]), want[r.row_id][1])


def test_scores_leave_no_shuffle_files(spark):
    df = spark.createDataFrame(made_rows(20_000, 50_000), "row_id long, lang string, t string").cache()
    df.count()
    assert left_behind(spark, lambda: sc.ngram_lm_score(df, "t", sc.ngram_lm_fit(df, "t"), sc.vocabulary_size(df, "t")).collect()) < 100_000
    df.unpersist()


def test_perplexity_filter_keeps_whole_result_without_shuffle_files(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, "wild", " ".join(f"v{rng.randrange(200_000)}" for _ in range(12))) for i in range(8_000)]
    rows += [(i, "calm", "a b a b a b") for i in range(8_000, 8_050)] + [(9_000, "short", "one"), (9_001, "none", None)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    vocabulary = len({w for _, _, t in rows for w in (t or "").split()})
    _, _, scores = scores_by_hand(rows, rows, 1, vocabulary)
    got = []
    assert left_behind(spark, lambda: got.extend(catalog.QUERIES["perplexity_filter"](spark, str(tmp_path)).collect())) < 100_000
    want = {(i, s) for i, s, _ in rows if scores.get(i, (0, 0))[0] <= 20_000}
    assert {(r.doc_id, r.source) for r in got} == want and len(got) == len(want) == 52


def test_blocks_given_once_serve_all_steps(spark):
    rows = made_rows(60)
    df = spark.createDataFrame(rows, "row_id long, lang string, t string")
    with bl.block_table(df, ["row_id"], "t") as tokens:
        size = sc.vocabulary_size(df, "t", tokens)
        got = sc.ngram_lm_score(df, "t", sc.ngram_lm_fit(df, "t", tokens), size, tokens=tokens)
    assert size == sc.vocabulary_size(df, "t") == len({w for _, _, t in rows for w in t.split()})
    _, _, want = scores_by_hand(rows, rows, 1, size)
    assert {r.row_id: (pytest.approx(r.perplexity), r.n_bigrams) for r in got.collect()} == want
