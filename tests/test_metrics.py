from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.functions import alignment as al
from tablewright.functions.porter import stem
from tablewright.operators import overlap as ov
from tablewright.operators import reports as rp
from tablewright.operators import scores as sc
from tablewright.operators.stats import exact_percentiles


def py_grams(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def py_bleu(pairs, smoothing="exp"):
    """pairs: (prediction tokens, list of reference tokens)"""
    match, total, hyp, ref = [0] * 4, [0] * 4, 0, 0
    for pred, refs in pairs:
        for n in range(1, 5):
            own = py_grams(pred, n)
            best: Counter = Counter()
            for r in refs:
                best |= py_grams(r, n)
            match[n - 1] += sum((own & best).values())
            total[n - 1] += max(1, sum(own.values()))
        hyp += len(pred)
        ref += min((abs(len(r) - len(pred)), len(r)) for r in refs)[1]
    if match[0] == 0:
        return 0.0
    ps, zeros = [], 0
    for n, (m, t) in enumerate(zip(match, total)):
        if smoothing == "exp":
            ps.append((m or 0.1) / t)
        elif smoothing == "floor":
            ps.append(m / t if n == 0 else (m + 1) / (t + 1))
        else:
            zeros += m == 0
            ps.append(m / t if m else 1 / (2**zeros * t))
    bp = 1.0 if hyp > ref else math.exp(1 - ref / hyp)
    return bp * math.exp(sum(math.log(p) / 4 for p in ps))


SCHEMA = "dataset string, model string, example_id long, prediction string, reference string, references array<string>"


@pytest.fixture(scope="module")
def examples(spark):
    rng = random.Random(3)

    def text():
        return " ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 12)))

    rows = [("d", rng.choice(["m", "n"]), i, text(), text(), None) for i in range(40)]
    rows = [(*r[:5], [r[4], text()]) for r in rows]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("smoothing", ["exp", "floor", "add-k"])
def test_bleu(examples, smoothing):
    rows, df = examples
    stats = ov.bleu_stats(df)
    got = {r.example_id: r.sentence_bleu for r in ov.sentence_bleu(stats, smoothing=smoothing).collect()}
    for r in rows:
        assert got[r[2]] == pytest.approx(py_bleu([(r[3].split(), [t.split() for t in r[5]])], smoothing))
    for r in ov.corpus_bleu(stats, smoothing=smoothing).collect():
        pairs = [(x[3].split(), [t.split() for t in x[5]]) for x in rows if x[1] == r.model]
        assert r.bleu == pytest.approx(py_bleu(pairs, smoothing)) and r.n == len(pairs)


def test_rouge_n_and_distinct(examples):
    rows, df = examples
    got = {r.example_id: (r.rouge1, r.rouge2) for r in ov.rouge_n(df).collect()}
    assert len(got) == len(rows)
    for r in rows:
        for k, n in enumerate((1, 2)):
            a, b = py_grams(r[3].split(), n), py_grams(r[4].split(), n)
            m = sum((a & b).values())
            want = 2 * m / (sum(a.values()) + sum(b.values())) if m else 0.0
            assert got[r[2]][k] == pytest.approx(want)
    for r in ov.distinct_n(df, "prediction").collect():
        grams = [g for x in rows if x[1] == r.model for g in py_grams(x[3].split(), r.n).elements()]
        assert (r.unique_ngrams, r.total_ngrams) == (len(set(grams)), len(grams))


def test_self_bleu_against_all_others(examples):
    rows, df = examples
    for r in ov.self_bleu(df, "prediction", "example_id").collect():
        texts = [x[3].split() for x in rows if x[1] == r.model]
        want = np.mean([py_bleu([(t, texts[:i] + texts[i + 1 :])]) for i, t in enumerate(texts)])
        assert r.self_bleu == pytest.approx(want)


def dp_lcs(a, b):
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
    return int(t[-1, -1])


def dp_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_alignment_helpers():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 15))] for _ in range(2))
        assert al.lcs_length(a, b) == dp_lcs(a, b) == len(al.lcs_positions(a, b))
        assert al.edit_distance(a, b) == dp_edits(a, b)
    assert al.union_lcs([list("abcde")], [list("abfgh"), list("acehi")]) == pytest.approx(2 * 0.4 * 0.8 / 1.2)
    words = "the cat sat on the mat".split()
    assert al.meteor(words, [words]) == pytest.approx(1 - 0.5 / 6**3)
    assert al.meteor(["runs"], [["run"]]) == pytest.approx(0.5)
    assert al.meteor(["x"], [["y"], []]) == 0.0 == al.meteor([], [["y"]])
    assert al.meteor(["car"], [["auto"]], synonyms={"car": "v", "auto": "v"}) > 0


def test_stems():
    pairs = {
        "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre",
        "plastered": "plaster", "motoring": "motor", "conflated": "conflat", "hopping": "hop", "filing": "file",
        "happy": "happi", "relational": "relat", "digitizer": "digit", "triplicate": "triplic", "electrical": "electr",
        "goodness": "good", "allowance": "allow", "adoption": "adopt", "effective": "effect", "controlling": "control",
        "rolling": "roll", "dying": "die", "enjoy": "enjoy", "jumps": "jump", "jumped": "jump",
    }
    assert {w: stem(w) for w in pairs} == pairs


def test_row_scores(spark):
    rows = [("d", "m", 1, "the fox jumps\nover it", "the fox jumped\nover it", ["the fox jumped over it"])]
    df = spark.createDataFrame(rows, SCHEMA)
    plain, stemmed = sc.rouge_l(df).first(), sc.rouge_l(df, stem=True).first()
    assert plain.rougeL == pytest.approx(0.8) and stemmed.rougeL == stemmed.rougeLsum == pytest.approx(1.0)
    assert ov.rouge_n(df, stem=True).first().rouge1 == pytest.approx(1.0)
    assert sc.ter(df).first().ter == pytest.approx(0.2)
    assert sc.meteor(df).first().meteor > 0.9
    same = ov.chrf(df.withColumn("reference", F.col("prediction"))).first()
    assert same.chrf == pytest.approx(100.0)
    assert ov.exact_match(df.withColumn("reference", F.lit("The Fox jumps, over it!"))).first().exact_match == 1.0


def test_perplexity_and_pass_at_k(spark):
    chunks = spark.createDataFrame([(1.0, 512), (2.0, 100), (9.0, 1)], "loss double, n_tokens int")
    assert sc.perplexity(chunks).first().perplexity == pytest.approx(math.exp(712 / 612))
    assert sc.perplexity(chunks.filter("n_tokens < 2")).first().perplexity == math.inf
    windows = spark.range(1).select(*[sc.token_chunks(F.lit(n)) for n in (0, 1, 512, 513, 2000)]).first()
    assert list(windows) == [[0], [1], [512], [512, 1], [512, 512, 512, 464]]
    assert spark.range(1).select(sc.token_chunks(F.lit(2000), max_length=1024)).first()[0] == [512, 512]
    tries = spark.createDataFrame([(1, i < 3) for i in range(10)] + [(2, False)] * 10, "p int, ok boolean")
    got = {r.k: r.pass_at_k for r in sc.pass_at_k(tries, [1, 5, 20], ["p"], "ok").collect()}
    assert set(got) == {1, 5} and got[1] == pytest.approx(0.15)
    assert got[5] == pytest.approx((1 - math.comb(7, 5) / math.comb(10, 5)) / 2)


def test_bigram_model(spark):
    df = spark.createDataFrame([(1, "a b a b"), (2, "b a"), (3, "x")], "row_id long, t string")
    model = sc.ngram_lm_fit(df, "t")
    new = spark.createDataFrame([(9, "a b z q")], "row_id long, t string")
    got = sc.ngram_lm_score(new, "t", model, 3).first()
    ps = [(2 + 1) / (2 + 3), (0 + 1) / (2 + 3), 1 / 3]
    assert got.perplexity == pytest.approx(math.exp(-sum(map(math.log, ps)) / 3)) and got.n_bigrams == 3


def test_percentiles_match_numpy(many_chunks):
    rng = np.random.default_rng(0)
    rows = [("a" if i % 3 else "b", float(v)) for i, v in enumerate(rng.normal(size=500).round(2))]
    df = many_chunks.createDataFrame(rows, "g string, v double")
    points = [0, 12.5, 50, 75, 99.9, 100]
    for r in exact_percentiles(df, ["g"], "v", points).collect():
        assert r.value == pytest.approx(np.percentile([v for g, v in rows if g == r.g], r.p))
    whole = {r.p: r.value for r in exact_percentiles(df, [], "v", points).collect()}
    assert whole == pytest.approx({p: np.percentile([v for _, v in rows], p) for p in points})


def test_significance(many_chunks):
    diffs = [1, -2, 3, 3, -1, 5, 0, 4, 6, 2, 2, 7]
    df = many_chunks.createDataFrame([(i, float(d)) for i, d in enumerate(diffs)], "id long, d double")
    got = rp.wilcoxon_signed_rank(df, "d").first()
    nz = [d for d in diffs if d]
    ranks = {v: np.mean([i + 1 for i, x in enumerate(sorted(map(abs, nz))) if x == v]) for v in set(map(abs, nz))}
    assert got.w_plus == sum(ranks[abs(d)] for d in nz if d > 0) and got.n == len(nz)
    assert got.p_value == pytest.approx(math.erfc(abs(got.z) / math.sqrt(2)))
    test = rp.permutation_test(df, "d", "id", samples=500).first()
    assert test.mean_difference == pytest.approx(np.mean(diffs)) and 0 < test.p_value < 0.1
    interval = rp.bootstrap_ci(df, "d", "id", samples=400).first()
    assert interval.low < np.mean(diffs) < interval.high


def test_reports(spark):
    rows = [("base", "a", "rouge1", 0.7), ("tuned", "a", "rouge1", 0.8), ("base", "a", "bleu", 0.3)]
    metrics = spark.createDataFrame(rows, "model string, dataset string, metric string, value double")
    table = rp.comparison_table(metrics, ["base", "tuned"])
    assert {r.metric: (r.base, r.tuned) for r in table.collect()} == {"rouge1": ("0.7000", "0.8000"), "bleu": ("0.3000", "N/A")}
    text = rp.render_markdown(table, ["base", "tuned"])
    assert "## Dataset: a" in text and "| rouge1 | 0.7000 | 0.8000 |" in text
    delta = rp.delta_table(metrics, "base").first()
    assert delta.absolute == pytest.approx(0.1) and delta.relative_pct == pytest.approx(100 / 7)
    replies = spark.createDataFrame([('{"accuracy": 8}',), ("oops",)], "r string")
    judged = {r.category: r for r in rp.judge_scores(replies, "r", categories=["accuracy"]).collect()}
    assert (judged["accuracy"].mean_score, judged["accuracy"].n_malformed) == (8.0, 1)
    answers = spark.createDataFrame(
        [(1, "", 0.0), (2, "I'm sorry, I cannot help with this.", 0.1), (3, "ok", 0.2), (4, "go on " * 20, 0.3), (5, "a fine long answer", 0.9)],
        "id long, prediction string, s double",
    )
    got = {r.id: r.error_class for r in rp.failure_analysis(answers, "s", "id").collect()}
    assert got == {1: "empty", 2: "refusal", 3: "too_short", 4: "repeated"}


def test_calculate_all_takes_every_metric(spark):
    row = "'d' AS dataset, 'm' AS model, array(array(1.0, 0.0)) AS prediction_vectors, array(array(1.0, 0.0)) AS reference_vectors, 2.0D AS loss, 4 AS n_tokens"
    df = spark.sql(f"SELECT id AS example_id, 'the cat sat down' AS prediction, 'the cat sat up' AS reference, array('the cat sat up') AS references, {row} FROM range(2)")
    asked = ["f1", "ter", "self_bleu", "bertscore", "perplexity"]
    got = {r["metric"]: r["value"] for r in sc.calculate_all(df, asked).collect()}
    assert set(got) == {"f1", "ter", "self_bleu", "perplexity", "bertscore_precision", "bertscore_recall", "bertscore_f1"}
    assert got["ter"] == 0.25 and abs(got["perplexity"] - np.exp(2.0)) < 1e-9 and abs(got["bertscore_f1"] - 1) < 1e-9
    with pytest.raises(ValueError, match="Unknown metric: nonsense"):
        sc.calculate_all(df, ["nonsense"])
    with pytest.raises(ValueError, match="needs the columns"):
        sc.calculate_all(df.drop("loss"), ["perplexity"])
