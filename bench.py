"""Timings of headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewright.plans import catalog  # noqa: E402
from tablewright.session import local_session  # noqa: E402

HEADLINES = [
    "prepare",
    "prepare_profile",
    "validate",
    "clean",
    "dedup",
    "split_random",
    "split_stratified",
    "mix_custom",
    "interleave",
    "profile",
    "length_stats",
    "detect_language",
    "build_vocab",
    "encode",
    "pack_sequences",
    "rouge_n_summary",
    "rouge_l",
    "corpus_bleu",
    "meteor",
    "distinct_n",
    "self_bleu",
    "chrf",
    "ngram_lm_score",
    "cosine_similarity",
    "performance_summary",
    "latency_percentiles",
    "bootstrap_ci",
    "metric_summary",
    "running_best",
    "plateau_detect",
    "request_counters",
    "session_activity",
    "stream_request_counters",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINES
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tablewright-bench")
    times = {}
    for name in names:
        run(spark, name, folder)  # warm-up
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(repeats)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
