"""Work on trigrams and n-grams that stays in batches: whole results, and no row for each occurrence in a shuffle."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tablewright.functions import batches as ba
from tablewright.functions import grams as gr
from tablewright.functions import profiles as lp
from tablewright.operators import overlap as ov


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made_texts(n, seed=3):
    rng = random.Random(seed)
    signs = ["a", "ß", "É", "z", "中", "\U0001d41a", "q", "́"]
    return ["".join(rng.choice([*signs, " ", "-", "\n"]) for _ in range(rng.randrange(60))) for _ in range(n)]


def py_trigrams(text):
    found = []
    for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        found += [f" {w} "[i : i + 3] for i in range(len(w))]
    return Counter(found)


def test_pieces_cover_every_row_once():
    for sizes in ([], [0], [3, 0, 9, 1, 1, 1], [100], [1] * 20, [0, 0, 50, 0]):
        rows = pa.array(range(len(sizes)))
        parts = [p.to_pylist() for p in ba.pieces(rows, np.array(sizes, np.int64), 4)]
        assert sum(parts, []) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in p[:-1]) <= 4 for p in parts)


def test_profiles_count_in_batches(spark, monkeypatch):
    rows = [(i // 2 if i % 9 else None, t, [None, "x", "y"][i % 3]) for i, t in enumerate([*made_texts(120), None, "", "12"])]
    df = spark.createDataFrame(rows, "row_id long, text string, lang string")
    profiles = lp.learn_profiles(df, "text", "lang", 5)
    points = {}
    for lang in "xy":
        n = sum((py_trigrams(t) for _, t, x in rows if x == lang), Counter())
        whole = sum(n.values()) + len(n) + 1
        for gram, k in [*sorted(n.items(), key=lambda e: (-e[1], e[0]))[:5], ("", 0)]:
            points[lang, gram] = math.floor(1000 * math.log((k + 1) / whole))
    assert {(r.lang, r.gram): r.points for r in profiles.collect()} == points
    want = defaultdict(int)
    for row_id, t, _ in rows:
        for gram, k in py_trigrams(t).items():
            for lang in "xy":
                want[row_id, lang] += k * points.get((lang, gram), points[lang, ""])
    scores = lp.profile_scores(df, "text", profiles)
    assert {(r.row_id, r.lang): r.points for r in scores.collect()} == dict(want)
    assert "Generate" not in plan(scores)  # no row for each trigram
    monkeypatch.setattr(lp, "PROFILE_ROWS", 1)
    assert {(r.row_id, r.lang): r.points for r in lp.profile_scores(df, "text", profiles).collect()} == dict(want)


def py_grams(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def test_numbers_and_hashes_tell_ngrams_apart():
    rng = random.Random(5)
    lists = [[rng.choice("abc") for _ in range(rng.randrange(8))] for _ in range(60)] + [None, []]
    array = pa.array([["z"], *lists], pa.list_(pa.string())).slice(1)
    for kind in (gr.numbered, gr.hashed):
        for n, rows, codes in kind(array, (1, 2, 4)):
            marks = [codes] if kind is gr.numbered else codes
            want = [(i, tuple(t[k : k + n])) for i, t in enumerate(lists) for k in range(len(t or []) - n + 1)]
            assert rows.tolist() == [i for i, _ in want]
            for m in marks:
                names = {}
                assert all(names.setdefault(g, c) == c for (_, g), c in zip(want, m.tolist(), strict=True))
                assert len(set(names.values())) == len(names)


def test_examples_of_one_key_are_counted_together(spark):
    rows = [("d", "m", 1, "a b a", ["a b", "b a a"]), ("d", "m", 1, "a c", ["a", None]), (None, "m", None, None, ["x"]), ("d", "m", 2, "", [""])]
    df = spark.createDataFrame(rows, "dataset string, model string, example_id int, prediction string, references array<string>")
    stats = ov.order_stats(df, [(ov.each_text(lambda t: F.split(F.coalesce(t, F.lit("")), " ")), (1, 2))])
    got = {(r.dataset, r.example_id): tuple(r)[3:] for r in stats.collect()}
    assert len(got) == 3
    # texts of one side count together, of several references the highest count holds
    own, first, second = Counter("a b a a c".split()), Counter("a b a".split()), Counter(["b", "a", "a", ""])
    best = first | second
    assert got["d", 1][:3] == (sum((own & best).values()), sum(own.values()), sum(best.values()))
    two = py_grams("a b a".split(), 2) + py_grams("a c".split(), 2)
    refs = py_grams("a b".split(), 2) | py_grams("b a a".split(), 2)
    assert got["d", 1][3:] == (sum((two & refs).values()), sum(two.values()), sum(refs.values()))
    text = plan(ov.chrf(df.withColumn("reference", F.col("references")[0])))
    assert "_gram" not in text and " gram#" not in text  # no row for each n-gram
