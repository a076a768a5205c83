from __future__ import annotations

import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import telemetry as tm
from tablewright.plans import catalog
from tablewright.plans import prepare as pr
from tablewright.session import fresh_folder
from tablewright.sources import readers as rd
from tablewright.sources import writers as wr
from tablewright.streaming import streams as ss


def py_plateau(values, patience, threshold, higher=False):
    best, best_at, misses = None, 0, 0
    for i, v in enumerate(values, 1):
        if best is None or (v > best + threshold if higher else v < best - threshold):
            best, best_at, misses = v, i, 0
        else:
            misses += 1
            if misses >= patience:
                return best, best_at, misses, i
    return best, best_at, misses, None


@pytest.mark.parametrize("higher", [False, True])
def test_plateau(many_chunks, higher):
    rng = random.Random(4)
    runs = {r: [round(rng.gauss(10 - i * 0.02, 1), 2) for i in range(rng.randint(1, 60))] for r in range(12)}
    rows = [(r, i, v) for r, vs in runs.items() for i, v in enumerate(vs)]
    df = many_chunks.createDataFrame(rows, "run long, step long, value double")
    for patience, threshold in ((3, 0.0), (5, 0.3)):
        got = tm.plateau_detect(df, patience=patience, threshold=threshold, higher_is_better=higher).collect()
        assert {r.run: (r.best, r.best_evaluation, r.misses, r.stop_evaluation) for r in got} == {
            r: py_plateau(vs, patience, threshold, higher) for r, vs in runs.items()
        }


def test_metric_summary_keeps_first_tie(spark):
    rows = [("r", "loss", s, v) for s, v in enumerate([3.0, 1.0, 2.0, 1.0])]
    df = spark.createDataFrame(rows, "run string, metric string, step long, value double")
    row = tm.metric_summary(df).first()
    assert (row.current, row.best, row.best_step, row.n) == (1.0, 1.0, 1, 4)
    assert tm.metric_summary(df, higher_is_better=True).first().best_step == 0
    flags = {r.step: r.is_best for r in tm.running_best(df).collect()}
    assert flags == {0: True, 1: True, 2: False, 3: False}


def test_late_rows_are_counted(spark, sf):
    late = catalog.QUERIES["stream_late_rows"](spark, sf)
    assert late.first().late_rows > 0
    batch = catalog.QUERIES["request_counters"](spark, sf).filter("window_start < '2024-01-14'").count()
    assert late.filter("window_start < '2024-01-14'").count() == 0 < batch


def test_stream_equals_batch_over_many_files(spark, sf):
    folder = fresh_folder(spark, "files")
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartitionByRange(4, "event_id").write.parquet(folder)
    stream = ss.read_stream(spark, folder, events.schema, "parquet", files_per_trigger=1)
    got = ss.run_update_to_parquet(ss.running_stats(stream, ["event_type"], "value"), "stats", ["event_type"])
    want = ss.running_stats(events, ["event_type"], "value")
    assert {(r.event_type, r.n, r.max) for r in got.collect()} == {(r.event_type, r.n, r.max) for r in want.collect()}


def test_jsonl_keeps_bad_lines_and_skips_missing_paths(spark, tmp_path):
    (tmp_path / "train.jsonl").write_text('{"instruction": "a", "output": "é"}\n\n{broken\n')
    paths = {"train": str(tmp_path / "train.jsonl"), "test": str(tmp_path / "none.jsonl")}
    rows = rd.read_jsonl(spark, paths, rd.RECORD).collect()
    assert [(r.instruction, r.output, r.split) for r in rows if r[rd.CORRUPT] is None] == [("a", "é", "train")]
    assert [r[rd.CORRUPT] for r in rows if r[rd.CORRUPT]] == ["{broken"]
    with pytest.raises(FileNotFoundError):
        rd.read_jsonl(spark, {"x": "/nowhere"}, rd.RECORD)
    (tmp_path / "t.csv").write_text('body,k\n"two\nlines, ""quoted""",1\n')
    assert rd.read_csv(spark, str(tmp_path / "t.csv"), text_column="body").first().text == 'two\nlines, "quoted"'


def test_log_lines(spark):
    good = {"timestamp": "t", "level": "INFO", "message": "m", "line": 3, "step": 5, "loss": 0.5, "note": "x"}
    lines = spark.createDataFrame([(json.dumps(good),), ("not json",)], "value string")
    logs = rd.parse_log_json(lines)
    assert logs.filter("malformed").count() == 1
    assert [(r.step, r.metric, r.value) for r in rd.log_metrics(logs).collect()] == [(5, "loss", 0.5)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "é", "x")], "id long, s string, n string").repartition(2)
    for codec in ("snappy", "gzip", "lz4", "zstd", None):
        wr.write_parquet(df, str(tmp_path / f"p-{codec}"), codec)
        assert spark.read.parquet(str(tmp_path / f"p-{codec}")).count() == 2
    for _ in range(2):  # the second write replaces the first
        wr.write_arrow(df, str(tmp_path / "arrow"))
    back = rd.read_arrow(spark, str(tmp_path / "arrow"), df.schema)
    assert sorted(map(tuple, back.collect())) == [(1, "a", None), (2, "é", "x")]
    wr.write_arrow(df.filter("id > 9"), str(tmp_path / "empty"))
    assert rd.read_arrow(spark, str(tmp_path / "empty"), df.schema).count() == 0
    assert wr.export(df, str(tmp_path / "all"), ["jsonl", "nope"]) == ["nope"]
    assert '"n":null' in "".join(r[0] for r in spark.read.text(str(tmp_path / "all" / "jsonl")).collect())
    with pytest.raises(ValueError):
        wr.write_parquet(df, str(tmp_path / "x"), "rar")
    report = spark.createDataFrame([("m", "d", "bleu", 0.5)], "model string, dataset string, metric string, value double")
    wr.write_report_csv(report, str(tmp_path / "csv"))
    wr.write_report_json(report, str(tmp_path / "json"))
    wr.write_report_markdown(spark, "# Report", str(tmp_path / "md"))
    assert json.loads(spark.read.text(str(tmp_path / "json")).first()[0])["metrics"] == {"bleu": 0.5}


def test_catalog_and_selection(spark, sf):
    docs = rd.Dataset("docs", f"{sf}/documents.parquet", mapping={"row_id": "doc_id"}, max_samples=5)
    assert rd.read_named(spark, [docs]).count() == 5
    with pytest.raises(ValueError, match="Available: \\['docs'\\]"):
        rd.read_named(spark, [docs], ["other"])
    with pytest.raises(ValueError, match="no rows of dataset 'other'"):
        rd.select_dataset(rd.read_named(spark, [docs]), "other")
    many = spark.range(300).select(F.format_string("set%03d", "id").alias("dataset"))
    with pytest.raises(ValueError, match="'set000'.*'set299'"):
        rd.select_dataset(many, "other")


@pytest.mark.parametrize("split", ["random", "sequential", "stratified", "hash"])
def test_whole_preparation(spark, split):
    rows = [(i, "d", f"What is number {i % 50}?", "", f"It is number {i % 50}.") for i in range(60)]
    df = spark.createDataFrame(rows, rd.RECORD)
    out = pr.prepare(df, pr.Settings(split=split, stratify_by="dataset", tokenize=True, eos="</s>")).collect()
    assert len(out) >= 47 and len({r.text for r in out}) == len(out)
    assert {r.split for r in out} == {"train", "validation", "test"}
    assert all(len(r.input_ids) == 12 for r in out)


NOT_IN_SQL = {
    "normalize_nfkc", "rouge_n_stemmed", "stem_tokens", "rouge_l", "meteor", "calculate_all", "evaluation_report",
    "stream_late_rows",
}


def test_every_query_states_its_sql():
    assert set(catalog.QUERIES) - set(catalog.SQL) == NOT_IN_SQL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["prepare", "dedup", "split_random", "split_stratified", "mix_custom", "head_n", "interleave", "encode", "rouge_n",
     "corpus_bleu", "distinct_n", "self_bleu", "chrf", "ngram_lm_fit", "running_best", "performance_summary", "delta_table",
     "latency_percentiles", "bootstrap_ci", "conversations_to_pairs", "session_activity"],
)
def test_no_products_between_rows(spark, sf, name):
    text = plan(catalog.QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_shuffles(spark, sf):
    assert "Exchange hashpartitioning" not in plan(catalog.QUERIES["split_hash"](spark, sf))
    assert "Exchange hashpartitioning" not in plan(catalog.QUERIES["split_random"](spark, sf))
    counts = spark.createDataFrame([("d", "m", 1, "a", "b")], "dataset string, model string, example_id long, prediction string, reference string")
    from tablewright.operators import overlap as ov

    assert plan(ov.rouge_n(counts)).count("Exchange") == 1
    pushed = plan(spark.read.parquet(f"{sf}/documents.parquet").filter(F.col("lang") == "en").select("doc_id"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in pushed


def test_late_rows_of_more_batches_than_a_query_remembers(spark, tmp_path):
    """110 files, read one at a time in the order of their ages; every row is older than the first file's."""
    import json
    import os

    from tablewright.operators import dedup as dd
    from tablewright.streaming import streams as ss

    for i in range(110):
        rows = [{"id": 10 * i + k, "ts": f"2024-01-{20 if i == 0 else 1}T00:00:0{k}.000Z"} for k in range(2)]
        path = tmp_path / f"{i:03}.json"
        path.write_text("\n".join(map(json.dumps, rows)))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    held: list = []
    stream = ss.read_stream(spark, str(tmp_path), T.StructType().add("id", "long").add("ts", "timestamp"), "json", 1)
    with ss.LateRows(spark) as late:
        kept = ss.run_to_parquet(dd.stream_dedup(stream, ["id"], "ts", "1 hour"), "many", on_query=held.append)
    # the first two batches have no watermark yet
    assert kept.count() == 4 and late.of(held[0]) == 216
    assert late.batches[str(held[0].runId)] > 100 >= len(held[0].recentProgress)


def test_rows_of_several_frames_come_in_order():
    from tablewright.streaming.streams import in_order

    frames = [pd.DataFrame({"s": [5, 1, 9], "v": [0.5, 0.1, 0.9], "x": 1}), pd.DataFrame({"s": [2, 7], "v": [0.2, None], "x": 1}), pd.DataFrame({"s": [], "v": [], "x": []})]
    assert [s for s, _ in in_order(iter(frames), "s", "v")] == [1, 2, 5, 7, 9]


@pytest.mark.parametrize("hold", [False, True])
def test_runs_longer_than_a_batch_stop_alike(spark, tmp_path, hold):
    """Runs over five batches, rows out of order by less than the buffer, which is far smaller than a run."""
    import os

    from tablewright.streaming import plateau_state as ps

    rng = random.Random(7)
    runs = {r: [rng.random() * 10 / (1 + i / 40) for i in range(400)] for r in ("a", "b", "c")}
    rows = [(i + rng.randrange(8), r, i, v) for r, vs in runs.items() for i, v in enumerate(vs)]
    rows.sort()  # each is overtaken by fewer than eight others of its run
    if not hold:
        rows = [x for k in range(5) for x in rows if x[2] // 80 == k]  # batches come one after another
    for k in range(5):
        part = rows[k * 240 : (k + 1) * 240]
        path = tmp_path / f"{k}.json"
        path.write_text("\n".join(json.dumps({"run": r, "step": i, "value": v}) for _, r, i, v in part))
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    stream = ss.read_stream(spark, str(tmp_path), T.StructType().add("run", "string").add("step", "long").add("value", "double"), "json", 1)
    with ps.rocksdb_state(spark):
        got = ss.run_to_parquet(ps.stateful_plateau(stream, ["run"], "step", "value", 20, 0.5, reorder=16, hold=hold), "held").collect()
    assert {r.run for r in got} == {r for r, vs in runs.items() if stop_of(vs, 20, 0.5)} != set()
    for r in got:
        assert (r.best, r.stop_evaluation) == stop_of(runs[r.run], 20, 0.5) and r.late_rows == 0


def stop_of(values, patience, threshold):
    """(best, evaluation) at which a run stops, None if it does not."""
    best, misses = values[0], 0
    for i, v in enumerate(values[1:], 2):
        best, misses = (v, 0) if v < best - threshold else (best, misses + 1)
        if misses == patience:
            return best, i
    return None


def test_arrow_paths_must_be_reachable(spark):
    from types import SimpleNamespace

    from tablewright.session import reachable

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: "file:///shared/x")
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: "file:///shared/x"))
    for path in ("hdfs://c/out", "s3a://b/out", "file:///shared/x/out", "/shared/x/out"):
        assert reachable(cluster, path) == path
    for path in ("/tmp/out", "file:///tmp/out", "/shared/xy"):
        with pytest.raises(ValueError, match="own disk"):
            reachable(cluster, path)
    assert reachable(spark, "/tmp/out") == "/tmp/out"
