"""Importance resampling, source divergence and the Jaccard join against brute force."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablewright.llm import divergence, jaccard, resample

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, score string, rank int, weight int, node int, row string"
UPPER = {c: c + 32 for c in range(65, 91)}


def low(text: str | None) -> str:
    return (text or "").translate(UPPER)


def prose(seed: int, n: int, words: int = 100_000) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"W{x}" for x in rng.integers(0, words, n))


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, repeated rows, copies and near copies."""
    base = prose(1, 400)
    near = [base.replace(base.split()[50 * k], f"other{k}", 1) for k in range(1, 7)]
    short = "a b c d e f g h i j"
    return [
        (0, base), *((k + 20, t) for k, t in enumerate(near)), (2, base.upper()), (3, None), (4, ""), (5, " \n\t"), (6, "one two"), (7, "One two"),
        (8, short), (9, short + " k"), (9, short + " k"), (10, prose(6, 20_000)), (11, prose(6, 20_000) + " tail"), (None, base), (None, prose(7, 80)),
        (None, prose(7, 80)), (12, "é ß 日本 😀 " * 10), (13, "x" * 30_000 + " y"), (14, "a b c d e f g h " * 12), (15, "Éa éa x-y 4th"), (16, prose(8, 25)),
        *((30 + k, " ".join(base.split()[: 400 - 20 * k] + prose(40 + k, 20 * k).split())) for k in range(1, 6)),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, None if i in (3, 9) else "en", f"src{(i or 0) % 3}" if i != 4 else None, "s", 1, 2, 3, "r") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_span_crcs():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 256, 400_000).astype(np.uint8)
    lengths = np.concatenate([rng.choice([1, 2, 9, 127, 128, 129, 255, 257, 1000], 500), [300_000, 150_000]])
    begin = rng.integers(0, 100_000, len(lengths))
    want = [zlib.crc32(data[b : b + n].tobytes()) for b, n in zip(begin, lengths, strict=True)]
    assert resample.span_crcs(data, begin, begin + lengths).tolist() == want


def by_hand(texts, target, share):
    def features(text):
        w = ALNUM.findall(low(text))
        return [zlib.crc32(x.encode()) % 10_000 for x in [*w, *(f"{a} {b}" for a, b in itertools.pairwise(w))]]

    have, want = (collections.Counter(b for t in side for b in features(t)) for side in ([t for _, t in texts], target))
    s, t = sum(have.values()), sum(want.values())
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1) * (s + 10_000) / ((have[b] + 1) * (t + 10_000))))
    rows = []
    for i, text in texts:
        found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= 39), key=lambda r: (-r[3], r[0] is None, r[0]))
    return rows, [(*r, k + 1) for k, r in enumerate(able[: share * len(able) // 100])]


def test_resampling(spark, docs, texts, nothing):
    target = [prose(1, 60), None, "", "one two three"]
    side = spark.createDataFrame([(t,) for t in target], "text string")
    for share in (25, 60, 100):
        rows, top = by_hand(texts, target, share)
        found = resample.resampled(docs, side, share)
        assert listed(found, "doc_id", "n_features", "weight", "score") == sorted(rows, key=str)
        assert listed(found.filter("rank IS NOT NULL"), "doc_id", "n_features", "weight", "score", "rank") == sorted(top, key=str)
    whole = resample.drawn(docs, side)
    assert {"text", "lang", "node"} <= set(whole.columns)
    assert whole.count() == len(by_hand(texts, target, 25)[1])
    assert resample.resampled(nothing, side).count() == 0
    assert resample.resampled(docs, side.limit(0)).count() == len(texts)


def audit_by_hand(rows, least):
    groups = collections.defaultdict(collections.Counter)
    docs = collections.Counter()
    for lang, source, text in rows:
        w = TERM.findall(low(text))
        groups[lang or "", source or ""].update(w)
        docs.update((lang or "", x) for x in set(w))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [x for (at, x), n in docs.items() if at == lang and n >= least]
        mine = {s: {x: c[x] for x in kept} for (at, s), c in groups.items() if at == lang}
        share = lambda c: {x: 1 + 10**9 * (n + 5) // (sum(c.values()) + 5 * len(kept)) for x, n in c.items()}  # noqa: B023, E731
        whole = share({x: sum(c[x] for c in mine.values()) for x in kept})
        p = {s: share(c) for s, c in mine.items()}
        for s in mine:
            pairs = [(o, sum(abs(p[s][x] - p[o][x]) for x in kept)) for o in mine if o != s]
            terms = [(x, p[s][x] - whole[x]) for x in kept if mine[s][x] and p[s][x] > whole[x]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, 50)):
                found.sort(key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, x, v, k + 1) for k, (x, v) in enumerate(found[:limit])]
    return out


COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def test_divergence(spark, docs, texts, nothing, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [("en" if i % 3 else "de", f"s{i % 7}", " ".join(f"W{chr(97 + x)}" for x in rng.zipf(1.4, 40) % 26)) for i in range(120)]
    rows += [("xx", "lone", "word"), ("xx", None, None), (None, "a", ""), ("en", "s😀", "Wa é"), *rows[:3]]
    df = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({"place": F.lit(1), "terms": F.lit("x"), "n": F.lit(0)})
    want = sorted(audit_by_hand(rows, 20), key=str)
    assert any(r[2] == "term" for r in want)
    assert listed(divergence.audit(df, 20), *COLUMNS) == want
    # several blocks of groups and of terms give the same
    monkeypatch.setattr(divergence, "CELL_POSTINGS", 10)
    monkeypatch.setattr(divergence, "CELL_PLACES", 14)
    assert listed(divergence.audit(df, 20), *COLUMNS) == want
    assert listed(divergence.audit(docs, 2), *COLUMNS) == sorted(audit_by_hand([(None if i in (3, 9) else "en", f"src{(i or 0) % 3}" if i != 4 else None, t) for i, t in texts], 2), key=str)
    assert divergence.audit(nothing).count() == 0


def shingles(text):
    w = WORD.findall(low(text))
    return {tuple(w)} - {()} if len(w) < 4 else {tuple(w[i : i + 4]) for i in range(len(w) - 3)}


def components_by_hand(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 85 * len(sets[i] | sets[j]):
            root[top(i)] = top(j)
    ids = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        ids[top(k)].append(i)
    return [(i, len(sets[k]), min((x for x in ids[top(k)] if x is not None), default=None)) for k, (i, _) in enumerate(rows)]


def test_jaccard(docs, texts, nothing):
    assert listed(jaccard.components(docs), "doc_id", "n_shingles", "component_id") == sorted(components_by_hand(texts), key=str)
    assert jaccard.components(nothing).count() == 0


def test_jaccard_near_the_bound(spark, monkeypatch):
    """Chains of sets of all sizes, on both sides of the bound, under every allocation and in small blocks."""
    rng = np.random.default_rng(3)
    rows = []
    for size in (4, 7, 9, 12, 17, 25, 40, 90, 200):
        base = prose(size, size).split()
        for _ in range(12):
            w = list(base)
            for _ in range(int(rng.integers(0, max(2, size // 8)))):
                at = int(rng.integers(0, len(w)))
                w[at : at + int(rng.integers(0, 2))] = [f"n{rng.integers(0, 4)}"] * int(rng.integers(0, 2))
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(components_by_hand(rows), key=str)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 1024)
    monkeypatch.setattr(jaccard, "BLOCK_NODES", 4)
    for choices in ((0.0,), (0.5,), (1.0,)):
        monkeypatch.setattr(jaccard, "CHOICES", choices)
        assert listed(jaccard.components(df), "doc_id", "n_shingles", "component_id") == want


def test_jaccard_small_keys_are_compared_in_place(spark, monkeypatch):
    """Only the sets of keys with several blocks are stored as blocks; pairs are the same."""
    rng = np.random.default_rng(5)
    members, sizes = [], {}
    for key, size in ((1, 3), (2, 8), (3, 60)):
        sizes[key] = range(1000 * key, 1000 * key + size)
        members += [(key, 1000 * key - 1, n, n) for n in sizes[key]]
    base = rng.integers(0, 256, 64, np.uint8)
    bits = [(n, 60, bytearray(base.tobytes())) for nodes in sizes.values() for n in nodes]
    named = spark.createDataFrame(members, "key long, centre long, node long, class long")
    held = spark.createDataFrame(bits, "node long, n long, bits binary")
    kept, before = {}, jaccard.stored

    def stored(df, label):
        kept[label] = before(df, label)
        return kept[label]

    monkeypatch.setattr(jaccard, "stored", stored)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 1024)
    monkeypatch.setattr(jaccard, "BLOCK_NODES", 16)
    found = {(r.a, r.b) for r in jaccard.across(named, held, jaccard.Bands.of()).collect()}
    assert found == {pair for nodes in sizes.values() for pair in itertools.combinations(nodes, 2)}
    assert {r.key for r in kept["blocks"].collect()} == {3}


def test_jaccard_moves_texts_of_open_pairs_only(spark, monkeypatch):
    """Documents that meet others by a passage they share are told apart by bits, without their texts."""
    shared = prose(500, 40)
    rows = [(k, f"{prose(600 + k, 90)} {shared}") for k in range(40)]
    rows.append((40, rows[0][1].replace(rows[0][1].split()[3], "other", 1)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept, before = collections.defaultdict(list), jaccard.stored

    def stored(df, label):
        kept[label].append(before(df, label))
        return kept[label][-1]

    monkeypatch.setattr(jaccard, "stored", stored)
    found = listed(jaccard.components(df), "doc_id", "n_shingles", "component_id")
    assert found == sorted(components_by_hand(rows), key=str)
    assert kept["nodes"][0].count() > 30
    assert {r.node for t in kept["ends"] for r in t.collect()} == {0, 40}
    assert not [t.columns for many in kept.values() for t in many if "text" in t.columns]


def test_jaccard_bits_are_those_of_the_first_text(spark):
    one, two = prose(1, 30), prose(2, 60)
    rows = [(1, max(one, two)), (1, min(one, two)), (2, one), (2, one), (3, two), (None, one), (None, one), (None, two), (None, None), (4, None), (4, two)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = jaccard.measured(df, jaccard.Bands.of())
    wanted = jaccard.with_nodes(df).filter("node <> 3").select("node").distinct()
    texts = jaccard.with_nodes(df).groupBy("node").agg(F.min("text").alias("text")).filter("text IS NOT NULL AND node <> 3")
    found = listed(jaccard.bits_for_nodes(marks, wanted, df).filter("n > 0"), "node", "n", "bits")
    assert found == listed(jaccard.with_bits(texts), "node", "n", "bits")
    assert len(found) == 5


def test_jaccard_keys_find_all_linked_sets():
    """Every two linked sets share a key of which one side is a whole subset."""
    rng = np.random.default_rng(8)
    bands = jaccard.Bands.of()
    texts = []
    for _ in range(400):
        k = int(rng.integers(0, 12))
        base = prose(k, 5 + 11 * k, 400).split()
        for _ in range(int(rng.integers(0, 3))):
            base[int(rng.integers(0, len(base)))] = f"n{rng.integers(0, 9)}"
        texts.append(" ".join(base))
    sets = jaccard.sets_of(pa.array(texts))
    whole = sets.each()
    links = {(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if jaccard.linked(whole[i], whole[j])}
    assert len(links) > 200
    for part in jaccard.CHOICES:
        held = collections.defaultdict(list)
        for band in jaccard.both_bands(sets, bands):
            for row, key, role in zip(*jaccard.keys_of(sets, band, bands, np.full(len(bands.low), part)), strict=True):
                held[int(key)].append((int(row), int(role)))
        met = {(min(a, b), max(a, b)) for rows in held.values() for (a, x), (b, y) in itertools.combinations(rows, 2) if x == 0 or y == 0}
        assert {(i, j) for i, j in links if not np.array_equal(whole[i], whole[j])} <= met
