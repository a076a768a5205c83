"""Scans, ranks, first rows, replicates, language profiles and metric folds."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.functions import profiles as lp
from tablewright.operators import dedup as dd
from tablewright.operators import mix as mx
from tablewright.operators import replicates as rr
from tablewright.operators import reports as rp
from tablewright.operators import scores as sc
from tablewright.operators import split as sp
from tablewright.operators import stats as st
from tablewright.operators.scan import Neighbour, RowNumber, Running, scan
from tablewright.operators.selection import first_per_group, values_at
from tablewright.plans import catalog
from tablewright.plans.views import table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A group with most rows, small groups, a null group, null values and text values."""
    rng = random.Random(4)
    rows = [("big" if i % 3 else None if i % 5 == 0 else f"g{i % 40}", i, rng.choice([None, rng.random(), 1.0]), f"t{i}") for i in range(4000)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "g string, at long, v double, text string").repartition(5)


def test_scan_of_skewed_groups(skewed):
    rows, df = skewed
    found = scan(
        df, ["g"], ["at"], RowNumber("rn"), Running("total", "sum", F.col("v")), Running("least", "min", F.col("v"), inclusive=False),
        Running("known", "count", F.col("v")), Neighbour("before", F.col("text")), Neighbour("after", F.col("v"), +1),
    )
    got = {(r.g, r["at"]): r for r in found.collect()}
    assert len(got) == len(rows)
    for group in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == group), key=lambda r: r[1])
        seen: list[float] = []
        for i, (g, at, v, _) in enumerate(mine):
            r = got[g, at]
            assert r.rn == i + 1 and r.least == (min(seen) if seen else None)
            seen += [] if v is None else [v]
            assert r.known == len(seen) and (r.total is None) == (not seen) and (not seen or r.total == pytest.approx(sum(seen)))
            assert r.before == (mine[i - 1][3] if i else None)
            assert r.after == (mine[i + 1][2] if i + 1 < len(mine) else None)


def test_scan_moves_wide_rows_once(skewed, spark):
    found = scan(skewed[1].repartition(3), ["g"], ["at"], RowNumber("rn"), Running("total", "sum", F.col("v")))
    text = plan(found).split("Subquery")[0]
    wide = [x for x in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text) if "__scan_chunk" in x]
    assert 1 <= len(wide) <= 2  # the rows, and the aggregated carry rows
    assert "rangepartitioning" not in text
    assert scan(skewed[1].limit(0), ["g"], ["at"], RowNumber("rn")).count() == 0
    assert scan(skewed[1], [], ["at"], RowNumber("rn")).filter("rn = at + 1").count() == 4000


def test_values_at_ranks(skewed):
    rows, df = skewed
    wanted = lambda n: F.array(*[F.struct(F.lit(name).alias("name"), k.cast("long").alias("k")) for name, k in (("low", F.lit(0)), ("mid", F.floor(n / 2)), ("none", n))])
    got = {(r.g, r["name"]): (r.v, r._total) for r in values_at(df, ["g"], "v", wanted).collect()}
    for group in {r[0] for r in rows}:
        mine = sorted(r[2] for r in rows if r[0] == group and r[2] is not None)
        assert got[group, "low"] == (mine[0], len(mine)) and got[group, "mid"] == (mine[len(mine) // 2], len(mine))
    assert not any(name == "none" for _, name in got)
    points = {(r.g, r.p): r.value for r in st.exact_percentiles(df, ["g"], "v", [0, 37.5, 99.9]).collect()}
    for group in {r[0] for r in rows}:
        mine = [r[2] for r in rows if r[0] == group and r[2] is not None]
        for p in (0, 37.5, 99.9):
            assert points[group, p] == pytest.approx(np.percentile(mine, p))


def test_first_rows_need_no_scan(spark, skewed):
    rows, df = skewed
    first = first_per_group(df, ["g"], [F.col("at").desc()], 3, "rn")
    assert "WindowGroupLimit" in plan(first)
    assert {(r.g, r["at"]) for r in first.collect()} == {
        (g, a) for g in {r[0] for r in rows} for a in sorted((r[1] for r in rows if r[0] == g), reverse=True)[:3]
    }
    for n in (3, 1500):  # kept by tasks, and counted
        head = sp.head_n(df, n, by="g", row_id="at")
        assert "__scan" not in plan(head)
        assert head.count() == sum(min(n, sum(r[0] == g for r in rows)) for g in {r[0] for r in rows})
    requests = df.selectExpr("g as model", "at", "v as latency_ms", "at as tokens_generated", "v as memory_used_mb")
    summary = rp.performance_summary(requests, ["model"], ["at"], warmup=3)
    assert "__scan" not in plan(summary)
    assert {r.model: r.runs for r in summary.collect()}["big"] == sum(r[0] == "big" for r in rows) - 3


def test_draws_are_md5():
    ids = ["1", "23", "x" * 20, "é" * 30, "", "7" * 60]
    got = rr.draws(ids, 1100, 42)
    for i, x in enumerate(ids):
        for r in (1, 9, 10, 99, 100, 999, 1000, 1100):
            assert got[i, r - 1] == int(hashlib.md5(f"42:{r}:{x}".encode()).hexdigest()[:8], 16)


def test_replicates_are_not_rows(spark):
    rows = [(i % 3 or None, i, float(i % 7) if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "g long, id long, v double")
    found = rp.bootstrap_ci(df, "v", "id", ["g"], samples=50)
    assert "sequence" not in plan(found)
    bounds = rp.poisson_bounds()
    for r in found.collect():
        mine = [x for x in rows if x[0] == r.g]
        means = []
        for k in range(1, 51):
            times = {x[1]: sum(int(hashlib.md5(f"42:{k}:{x[1]}".encode()).hexdigest()[:8], 16) / 2**32 >= b for b in bounds) for x in mine}
            if sum(times.values()):
                means.append(sum(times[x[1]] * (x[2] or 0.0) for x in mine) / sum(times.values()))
        assert r.low == pytest.approx(np.percentile(means, 2.5)) and r.high == pytest.approx(np.percentile(means, 97.5))
    assert rp.permutation_test(df, "v", "id", ["g"], samples=50).count() == 3
    assert rp.bootstrap_ci(df.limit(0), "v", "id", ["g"]).count() == 0


def test_many_sources_are_mixed(spark):
    n = 200_000
    df = spark.range(n * 2).select((F.col("id") % n).cast("string").alias("dataset"), F.col("id").alias("row_id"))
    drawn = mx.mix(df, "equal", n * 3)
    assert drawn.count() == n * 3
    assert drawn.groupBy("dataset").count().agg(F.min("count"), F.max("count")).first()[:2] == (3, 3)
    weights = spark.range(n).select(F.col("id").cast("string").alias("dataset"), F.lit(1.0).alias("weight"))
    assert mx.mix(df, "custom", n, weights).count() == n


def test_curriculum_with_null_and_absent_sources(spark):
    df = spark.createDataFrame([(None if i % 3 == 0 else f"s{i % 3}", i) for i in range(30)], "dataset string, row_id long")
    out = mx.curriculum(df, [(0, {None: 1.0, "s1": 1.0}), (4, {"s2": 1.0})], 6, 10).collect()
    by_stage = lambda k: [r for r in out if r.stage == k]
    assert len(by_stage(0)) == 40 and {r.dataset for r in by_stage(0)} == {None, "s1"}
    assert len(by_stage(1)) == 20 and {r.dataset for r in by_stage(1)} == {"s2"}
    assert sorted(r.step for r in out) == [k for k in range(6) for _ in range(10)]
    with pytest.raises(ValueError, match="unknown"):
        mx.curriculum(df, [(0, {"zzz": 1.0})], 6, 10)


def test_dedup_fetches_later_copies_only(spark):
    df = spark.createDataFrame([(i, "same" if i % 2 else f"t{i}", None) for i in range(50)], "row_id long, instruction string, output string")
    kept = dd.dedup(df)
    assert sorted(r.row_id for r in kept.collect()) == sorted([1, *range(0, 50, 2)])
    assert "BroadcastHashJoin [row_id" in plan(kept) and "LeftAnti" in plan(kept)


def test_languages_by_profile(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    learn, held = docs.filter("doc_id % 5 <> 0"), docs.filter("doc_id % 5 = 0")
    profiles = lp.learn_profiles(learn, "text", "lang")
    assert profiles.groupBy("lang").count().filter(F.col("count") > lp.PROFILE_SIZE + 1).count() == 0
    found = lp.profiled_language(held, "text", profiles, "doc_id").join(held, "doc_id")
    right, n = found.select(F.sum((F.col("detected") == F.col("lang")).cast("int")), F.count("*")).first()
    assert right / n > 0.95, (right, n)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 -- 7")], "row_id long, text string")
    assert [r.detected for r in lp.profiled_language(odd, "text", profiles).collect()] == ["und"] * 3
    status = {r.lang: r.status for r in lp.expected_languages(found, ["de", "xx"]).collect()}
    assert status["de"] == "present" and status["xx"] == "missing" and status["en"] == "unexpected"


def test_folds_and_direction(spark):
    rows = [("d", m, f"{'x' * (i * (2 if m == 'b' else 1))}", "y" * i) for m in ("a", "b") for i in range(1, 30)]
    df = spark.createDataFrame(rows, "dataset string, model string, prediction string, reference string").repartition(4)
    fold = sc.Fold(
        ("prediction", "reference"), lambda: [0.0, 0.0], lambda s, b: [s[0] + float((b["prediction"].str.len() - b["reference"].str.len()).abs().sum()), s[1] + len(b["prediction"])],
        lambda x, y: [x[0] + y[0], x[1] + y[1]], lambda s: s[0] / s[1],
    )
    sc.fold_metric("test_gap", fold, higher_is_better=False)
    values = sc.calculate_all(df, (), ["test_gap"])
    assert {r.model: r.value for r in values.collect()} == {"a": 0.0, "b": 15.0}
    best = sc.best_and_worst(values).first()
    assert (best.best_model, best.worst_model) == ("a", "b")
    with pytest.raises(ValueError):
        sc.calculate_all(df, (), ())


def test_idf_weights(spark):
    one = [1.0, 0.0]
    two = [0.0, 1.0]
    rows = [(1, True, 0, "rare", one), (1, True, 1, "often", two), (1, False, 0, "often", one), (1, False, 1, "rare", one), (2, False, 0, "often", one), (2, True, 0, "new", one)]
    df = spark.createDataFrame(rows, "example long, predicted boolean, position int, token string, vector array<double>")
    got = {r.example: r for r in sc.idf_bertscore(df, ["example"]).collect()}
    # `often` is in both references and weighs nothing
    assert got[1].bertscore_precision == pytest.approx(1.0) and got[1].bertscore_recall == pytest.approx(1.0)
    assert got[2].bertscore_precision == pytest.approx(1.0) and got[2].bertscore_recall == 0.0
    idf = {r.token: r.idf for r in sc.token_idf(df.filter("NOT predicted"), ["example"]).collect()}
    assert idf["rare"] == pytest.approx(math.log(3 / 2)) and idf["often"] == 0.0


def test_new_queries_have_sql():
    for name in ("language_profiles", "profiled_language", "expected_languages", "full_profile", "bertscore_idf", "bertscore_summary", "fold_metric", "best_and_worst",
                 "rouge_l_words", "ter", "calculate_most", "evaluation_table", "write_report_csv", "write_report_json", "write_report_markdown"):
        assert name in catalog.QUERIES and name in catalog.SQL
