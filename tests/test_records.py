from __future__ import annotations

import hashlib
import random
import weakref

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.functions import text as tx
from tablewright.functions.language import detect_language
from tablewright.operators import clean as cl
from tablewright.operators import cuts
from tablewright.operators import dedup as dd
from tablewright.operators import mix as mx
from tablewright.operators import split as sp
from tablewright.operators import stats as st
from tablewright.operators import templates as tp
from tablewright.operators import tokens as tk
from tablewright.operators import validate as va
from tablewright.operators.scan import Neighbour, RowNumber, Running, scan
from tablewright.operators.sized import lookup
from tablewright.plans import catalog


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("t")).alias("v")).collect()]


ODD = ["\t a b \n", "\x1cx\x85", "\xa0 é  ", "", "   ", "a\x0b b", "​z​", "x"]


def test_strip_and_words_follow_python(spark):
    assert column(spark, ODD, tx.strip) == [t.strip() for t in ODD]
    assert column(spark, ODD, tx.words) == [t.split() for t in ODD]
    assert column(spark, ODD, tx.is_blank) == [not t.strip() for t in ODD]
    assert column(spark, ODD, tx.word_count) == [len(t.split()) for t in ODD]


def test_tags_truncate_chunks_ngrams(spark):
    assert column(spark, ["<b>a</b> < c"], tx.remove_tags) == ["a < c"]
    texts = ["", "abc", "abcdefghij", "abcdefghijk"]
    want = [t if len(t) <= 10 else t[:7] + "..." for t in texts]
    assert column(spark, texts, lambda c: tx.truncate_text(c, 10)) == want

    def windows(t, size, overlap):
        w, out = t.split(" "), []
        for i in range(0, len(w), size - overlap):
            out.append(" ".join(w[i : i + size]))
            if i + size >= len(w):
                break
        return out

    long = [" ".join(map(str, range(n))) for n in (1, 2, 3, 4, 5, 9, 10, 11, 23)]
    for size, overlap in ((3, 0), (4, 1), (5, 4)):
        assert column(spark, long, lambda c: tx.chunk_text(c, size, overlap)) == [windows(t, size, overlap) for t in long]
    grams = column(spark, ["a b c d", "a"], lambda c: tx.ngrams(tx.words(c), 3, " "))
    assert grams == [["a b c", "b c d"], []]
    labelled = column(spark, ["a b c"], lambda c: tx.ngrams_up_to(tx.words(c), 2, " "))[0]
    assert [(g["n"], g["gram"]) for g in labelled] == [(1, "a"), (1, "b"), (1, "c"), (2, "a b"), (2, "b c")]


def test_nfkc_and_noise(spark):
    texts = ["ﬁne ①", "Ｆull", "plain", None]
    assert column(spark, texts, cl.nfkc) == ["fine 1", "Full", "plain", None]
    words = [f"w{i}" for i in range(200)]
    df = spark.createDataFrame([(7, " ".join(words))], "id long, t string")

    def u(i):
        return int(hashlib.md5(f"42:7:{i}".encode()).hexdigest()[:8], 16) / 16**8

    kinds = ["delete", "insert", "swap"]
    got = cl.inject_noise(df, "t", "id", 0.6, kinds).first()["t"].split()
    want = []
    for i, w in enumerate(words):
        k = int(u(i) // 0.2)
        want.append((i + (1.5 if k == 2 else 0), [] if k == 0 else [w, w] if k == 1 else [w]))
    assert got == [w for _, ws in sorted(want, key=lambda x: x[0]) for w in ws]


def test_language(spark):
    texts = ["the cat and the dog", "der Hund und die Katze", "le chat et les chiens", "123", None]
    assert column(spark, texts, detect_language) == ["en", "de", "fr", "und", "und"]


RECORDS = "row_id long, instruction string, input string, output string"


def test_validation(spark):
    rows = [
        (1, "What is the answer?", "", "Forty-two."),
        (2, "   ", "", "Forty-two."),
        (3, "Short", "", "Ok"),
        (4, None, "", "Forty-two."),
        (5, "x" * 8192, "", "12345"),
        (6, "x" * 8193, "", "12345"),
    ]
    df = spark.createDataFrame(rows, RECORDS)
    assert [r.row_id for r in va.validate(df).orderBy("row_id").collect()] == [1, 5]
    reasons = {r.row_id: r.reason for r in va.rejected(df).collect()}
    assert reasons == {2: "blank_required", 3: "instruction_length", 4: "null_required", 6: "instruction_length"}
    with pytest.raises(ValueError, match="Missing required"):
        va.validate(df.drop("output"))


def test_clean(spark):
    df = spark.createDataFrame([(1, "  test  ", "<p>x</p>", "y"), (2, "a", None, "b")], RECORDS)
    assert [tuple(r) for r in cl.clean(df).collect()] == [(1, "test", "x", "y")]
    assert cl.clean(df, drop_nulls=False).count() == 2
    with pytest.raises(ValueError, match="Unknown cleaners"):
        cl.clean(df, custom=["nope"])


def test_records_are_cleaned_once(spark, tmp_path):
    df = spark.createDataFrame([(1, "<b>x</b>", "", "y"), (2, None, "", "z"), (3, " ", "", None)], RECORDS)
    plan = cl.clean(df)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert not any("regexp_replace" in line for line in filters)  # nulls are found without cleaning
    assert [r.row_id for r in cl.clean(df).collect()] == [1]

    texts = ["Say it twice\n <b>one two</b> one", "no second line", None, "Say it once\nthree four five"]
    rows = [(i, t, "en", None if i == 3 else "web") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    tokens = catalog.QUERIES["prepare_tokens"](spark, str(tmp_path))
    assert [tuple(r) for r in tokens.collect()] == [(0, 10)]
    assert "<[^>]+>" not in tokens._jdf.queryExecution().optimizedPlan().toString()  # stored after cleaning


def test_dedup_keeps_first_and_nulls_are_equal(spark):
    rows = [(3, "a", None, "x"), (1, "a", None, "x"), (2, "a", "", "x"), (4, "1:a", "", "x"), (5, "a", "", "x")]
    df = spark.createDataFrame(rows, RECORDS)
    once = dd.dedup(df)
    assert sorted(r.row_id for r in once.collect()) == [1, 2, 4]
    assert dd.dedup(once).count() == 3
    assert sorted(r.row_id for r in dd.dedup(df.repartition(5)).collect()) == [1, 2, 4]


def test_templates(spark):
    df = spark.createDataFrame([(1, "A", "C", "B"), (2, " A ", "  ", "B")], RECORDS)

    def texts(**options):
        return [r.text for r in tp.format_table(df, **options).orderBy("row_id").collect()]

    custom = dict(template="custom", custom="{instruction} -> {output}", custom_with_input="{instruction} [{input}] -> {output}")
    assert texts(**custom) == ["A [C] -> B", "A -> B"]
    assert texts(template="alpaca", eos="!")[1] == "### Instruction:\nA\n\n### Response:\nB!"
    assert "im_start>user\nA\n\nCim_end>" in texts(template="chatml_legacy")[0]
    assert texts(template="nope", default="vicuna") == texts(template="vicuna")
    with pytest.raises(ValueError, match="Unknown formatter"):
        texts(template="nope")
    with pytest.raises(ValueError, match="Unknown placeholder"):
        texts(template="custom", custom="{what}")
    kept = tp.format_table(df, "alpaca", keep_columns=True)
    assert kept.columns == ["row_id", "instruction", "input", "output", "text"]


def test_scan_matches_brute_force(many_chunks):
    spark, rng = many_chunks, random.Random(1)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), i, rng.choice([None, *range(9)])) for i in range(800)]
    df = spark.createDataFrame(rows, "g string, i long, v long").repartition(7)
    got = scan(
        df, ["g"], ["i"],
        RowNumber("rn"),
        Running("s", "sum", F.col("v")),
        Running("lo", "min", F.col("v"), inclusive=False),
        Running("c", "count", F.col("v")),
        Neighbour("prev", F.col("v"), -1),
        Neighbour("next", F.col("v"), +1),
    )
    seen: dict = {}
    for g, i, v in rows:
        seen.setdefault(g, []).append((i, v))
    want = set()
    for g, items in seen.items():
        for k, (i, v) in enumerate(items):
            upto = [x for _, x in items[: k + 1] if x is not None]
            before = [x for _, x in items[:k] if x is not None]
            want.add((
                g, i, v, k + 1, sum(upto) if upto else None, min(before) if before else None, len(upto),
                items[k - 1][1] if k else None, items[k + 1][1] if k + 1 < len(items) else None,
            ))
    assert {tuple(r) for r in got.collect()} == want
    whole = scan(df, [], [F.col("i").desc()], RowNumber("rn")).select("i", "rn").collect()
    assert all(r.i + r.rn == 800 for r in whole)


def py_sizes(total, ratios, least):
    rt, rv, re = (ratios[s] for s in sp.NAMES)
    if total < sum(least.values()):
        train = max(1, min(total, int(total * rt)))
        val = max(0, min(total - train, int(total * rv)))
        return train, val, total - train - val
    train, val, test = (max(int(total * r), least[s]) for r, s in zip((rt, rv, re), sp.NAMES))
    if train + val + test > total:
        scale = total / (train + val + test)
        train, val = int(train * scale), int(val * scale)
        test = total - train - val
    return train, val, test


def test_split_sizes(spark):
    for ratios in ({"train": 0.8, "validation": 0.1, "test": 0.1}, {"train": 0.34, "validation": 0.33, "test": 0.33}):
        for least in (sp.DEFAULT_MINIMUMS, {"train": 5, "validation": 4, "test": 3}):
            for total in (1, 2, 3, 7, 12, 13, 99, 100):
                sizes = sp.split_sizes(F.lit(total), ratios, least)
                got = spark.range(1).select(*[sizes[s] for s in sp.NAMES]).first()
                assert tuple(got) == py_sizes(total, ratios, least), (total, ratios, least)
    with pytest.raises(ValueError):
        sp.validate_ratios({"train": 0.8, "validation": 0.1, "test": 0.2})


def test_splits(many_chunks, monkeypatch):
    monkeypatch.setattr(cuts, "_ROWS_PER_BUCKET", 5)  # several digits of the key are used
    ratios = {"train": 0.8, "validation": 0.1, "test": 0.1}
    df = many_chunks.range(100).withColumnRenamed("id", "row_id").withColumn("label", F.col("row_id") % 3)
    for split in (sp.split_random, sp.split_sequential):
        rows = split(df, ratios).collect()
        sizes = {s: sum(r.split == s for r in rows) for s in sp.NAMES}
        assert sizes == {"train": 80, "validation": 10, "test": 10} and len({r.row_id for r in rows}) == 100
    assert [r.row_id for r in sp.split_sequential(df, ratios).filter("split = 'test'").orderBy("row_id").collect()] == list(range(90, 100))
    again = sp.split_random(df.repartition(9), ratios).orderBy("row_id").collect()
    assert again == sp.split_random(df, ratios).orderBy("row_id").collect()
    strata = sp.split_stratified(df, "label", ratios).groupBy("label", "split").count().collect()
    assert {(r.label, r.split): r["count"] for r in strata}[(0, "train")] == int(34 * 0.8)
    order = sorted(range(100), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert sorted(r.row_id for r in st.sample_rows(df, 17).collect()) == sorted(order[:17])
    assert st.sample_rows(df, 0).count() == 0 and st.sample_rows(df, 1000).count() == 100
    assert [r.row_id for r in sp.shuffle(df).orderBy("position").collect()] == order


def test_mixing(many_chunks):
    rows = [("a", i) for i in range(10)] + [("b", 100 + i) for i in range(3)]
    df = many_chunks.createDataFrame(rows, "dataset string, row_id long")
    out = mx.mix(df, "custom", 20, {"a": 1.0, "b": 3.0}).groupBy("dataset").count().collect()
    assert {r.dataset: r["count"] for r in out} == {"a": 5, "b": 15}
    order = [r.row_id for r in mx.interleave(df).orderBy("position").collect()]
    assert order == [0, 100, 1, 101, 2, 102, *range(3, 10)]
    assert mx.interleave(df, stop_on_shortest=True).count() == 6
    with pytest.raises(ValueError):
        mx.mix(df, "custom", weights={"zzz": 1.0})
    steps = mx.curriculum(df, [(0, {"a": 1.0}), (3, {"b": 1.0})], 5, 2).collect()
    assert sorted(r.step for r in steps) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
    assert all((r.dataset == "a") == (r.step < 3) for r in steps)


def test_encode_routes_agree(spark):
    rows = [(1, "the cat sat on the mat"), (2, ""), (3, None), (4, "unseen " * 5 + "cat")]
    df = spark.createDataFrame(rows, "row_id long, text string")
    vocab = tk.build_vocab(df.filter("row_id < 4"), "text", 8)
    assert [r.token for r in vocab.orderBy("token_id").collect()] == [*tk.SPECIALS, "the", "cat", "mat", "on"]
    for options in ({}, {"max_length": 4, "truncation_side": "left", "add_bos": True}, {"max_length": 4, "add_eos": True}):
        fast = tk.encode(df, "text", vocab, **options).orderBy("row_id").collect()
        joined = tk.encode(df, "text", vocab, max_vocab_rows=1, **options).orderBy("row_id").collect()
        assert [r.input_ids for r in fast] == [r.input_ids for r in joined]
        assert all(len(r.input_ids) == len(r.attention_mask) for r in fast)
    assert tk.encode(df, "text", vocab).orderBy("row_id").first().input_ids == [4, 5, 1, 7, 4, 6]
    own = tk.encode_with(df, "text", lambda t: [len(w) for w in t.split()]).orderBy("row_id").first()
    assert own.input_ids == [3, 3, 3, 2, 3, 3]


def test_lookup_holds_little_of_a_batch(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a b")], "row_id long, text string")
    table = pa.table({"token": ["a", "b"], "token_id": pa.array([4, 5], pa.int32())})
    monkeypatch.setattr(tk, "PIECE_TOKENS", 6)
    lists = [["a", "b"], [], ["x"] * 9, ["b", "x", "a"], ["a"]] * 3
    seen = []

    def batches():
        for _ in range(2):
            batch = pa.array([["z"], *lists], pa.list_(pa.string())).slice(1)  # offsets need not start at zero
            seen.append(weakref.ref(batch))
            yield batch
            del batch
            assert seen[-1]() is None  # a batch is gone before the next one is read
        yield pa.array([], pa.list_(pa.string()))

    out = [x.to_pylist() for x in tk._vocab_lookup(df, table, 1).func(batches())]
    assert sum(out, []) == [[{"a": 4, "b": 5}.get(t, 1) for t in x] for x in lists] * 2
    # a piece is ended by the list that crosses a bound, so a long list is never joined by many
    assert len(out) > 4 and all(sum(map(len, x)) <= 6 + 9 for x in out)


def test_sequences(many_chunks):
    lists = [(1, [1, 1, 1]), (2, [2, 2]), (3, [3] * 5), (4, []), (5, [5] * 11)]
    df = many_chunks.createDataFrame(lists, "row_id long, input_ids array<int>")
    seen = tk.analyze_sequences(df.filter("row_id < 4"), limit=5).first()
    assert (seen.n_sequences, seen.mean, seen.min, seen.max, seen.at_limit) == (3, 10 / 3, 2, 5, 1)
    flat = [x for _, ids in lists for x in ids]
    packed = [r.input_ids for r in tk.pack_sequences(df, 4).orderBy("block").collect()]
    assert packed == [flat[i : i + 4] for i in range(0, len(flat), 4)]
    assert tk.pack_sequences(df, 4, drop_last=True).count() == len(flat) // 4
    masked = df.withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1)))
    padded = tk.build_labels(tk.pad(tk.assign_batches(masked, 2), side="left")).orderBy("row_id").collect()
    assert [len(r.input_ids) for r in padded] == [8, 8, 8, 8, 16]
    assert padded[1].labels == [-100] * 6 + [2, 2]


def test_statistics(spark):
    df = spark.createDataFrame([(1, "a" * 5, "", None), (2, "b" * 25, " ", "x"), (3, "c" * 100, "z", "y")], RECORDS)
    row = st.length_stats(df, ["instruction"]).first()
    assert (row.n, row.min, row.max, row.p50) == (3, 5, 100, 25.0)
    assert [tuple(r) for r in st.null_counts(df).collect()] == [("output", 1)]
    assert [tuple(r) for r in st.empty_counts(df).collect()] == [("input", 2)]
    names = ["instruction", "input"]
    assert st.dataset_fingerprint(df, names).first() == st.dataset_fingerprint(df.repartition(3), names).first()


def test_lookup_salts_hot_keys(spark):
    big = spark.range(400).withColumn("k", F.when(F.col("id") < 300, "hot").otherwise(F.col("id").cast("string")))
    small = big.groupBy("k").agg(F.count("*").alias("n"))
    want = sorted(map(tuple, big.join(small, "k").select("id", "k", "n").collect()))
    for options in ({"max_rows": 10}, {"max_rows": 10, "weight": "n", "rows_per_task": 50}, {}):
        got = lookup(big, small, ["k"], **options).select("id", "k", "n").collect()
        assert sorted(map(tuple, got)) == want


def test_rows_with_a_null_group_are_cut_like_any_other(spark):
    rows = spark.createDataFrame([(i, None if i % 4 == 0 else f"l{i % 3}") for i in range(100)], "row_id long, label string")
    found = sp.split_stratified(rows, "label")
    assert found.columns == ["row_id", "label", "split"] and found.count() == 100
    assert {r["split"]: r["count"] for r in found.filter("label IS NULL").groupBy("split").count().collect()} == {"train": 22, "validation": 1, "test": 2}
    assert sp.sample_by_label(rows, "label", 5).filter("label IS NULL").count() == 5
    assert sp.head_n(rows, 0, by="label").count() == 0
    equal = mx.mix(rows, "equal", source="label")
    assert equal.count() == 100 and equal.filter("label IS NULL").count() == 25
    positions = [r["position"] for r in mx.interleave(rows, source="label").orderBy("position").collect()]
    assert positions == list(range(100))


def test_size_bounds_are_known_before_rows_are_fetched(spark):
    from tablewright.operators.sized import small_table

    wide = spark.range(50).select(F.repeat(F.lit("x"), 10_000).alias("t"))
    assert small_table(wide, max_bytes=100_000) is None
    assert small_table(wide, max_rows=49) is None
    assert small_table(wide, max_rows=50).num_rows == 50


def test_several_hot_keys_are_salted(spark):
    from tablewright.operators.sized import lookup

    rows = spark.range(3000).select("id", F.when(F.col("id") < 1200, "a").when(F.col("id") < 2400, "b").otherwise(F.col("id").cast("string")).alias("k"))
    sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = lookup(rows, sizes, ["k"], weight="n", max_rows=1, rows_per_task=100)
    assert joined.count() == 3000
    assert joined.agg(F.sum("n")).first()[0] == 2 * 1200**2 + 600


def test_encoding_without_a_limit_keeps_every_token(spark):
    text = " ".join(f"w{i % 7}" for i in range(5000))
    rows = spark.createDataFrame([(1, text)], "row_id long, text string")
    vocab = tk.build_vocab(rows, "text", 100)
    assert len(tk.encode(rows, "text", vocab, max_length=None).first()["input_ids"]) == 5000
    assert len(tk.encode(rows, "text", vocab).first()["input_ids"]) == 2048
