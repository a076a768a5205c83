from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import decontaminate, html_text, mixture, near_dups, pii, quality, repeats, shards, token_ids, toxicity
from tablewright.session import shared_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, shard int"


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 100_000, n))


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, repeated rows, copies and near copies."""
    base, passage = prose(1, 400), prose(2, 60)
    near = base.replace(base.split()[200], "changed", 1)
    return [
        (0, base), (1, near), (2, base), (3, None), (4, ""), (5, ""), (6, "  \n\t "), (7, "one two"), (7, "one two"),
        (8, prose(3, 30) + " " + passage + " " + prose(4, 20)), (9, prose(5, 10) + "\n" + passage), (10, prose(6, 20_000)),
        (None, prose(7, 80)), (None, None), (11, "a b c d e f g h " * 12), (12, "é ß 日本 😀 " * 10), (13, "x" * 30_000),
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    shared_folder(spark)
    rows = [(i, t, "en" if (i or 0) % 2 else None, None if i in (3, 9) else f"src{(i or 0) % 3}", 0, -1, "r", 9) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_repeats(docs, texts, nothing):
    first: dict[tuple, float] = {}
    words = [(float("inf") if i is None else i, i, WORD.findall(t or "")) for i, t in texts]
    for rank, _, w in words:
        for j in range(len(w) - 49):
            key = tuple(w[j : j + 50])
            first[key] = min(first.get(key, float("inf")), rank)
    want = []
    for rank, i, w in words:
        gone = set()
        for j in range(len(w) - 49):
            if first[tuple(w[j : j + 50])] < rank:
                gone.update(range(j, j + 50))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = repeats.without_repeats(docs, part_bytes=4096)
    assert listed(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=str)
    assert repeats.without_repeats(nothing).count() == 0


def test_quality(docs, texts, nothing):
    want = []
    for i, text in texts:
        t = text or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        grams = collections.Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        again = {k for j in range(len(w) - 7) if grams[tuple(w[j : j + 8])] > 1 for k in range(j, j + 8)}
        base = len(w) < 20 or 100 * len(again) > 30 * len(w)
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), base))
    found = quality.verdicts(docs)
    assert listed(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want, key=str)
    assert found.filter("kept AND base_failed").count() == 0
    assert quality.verdicts(nothing).count() == 0


def test_ablations_follow_from_bits(spark):
    b = quality.BIT
    entries = spark.createDataFrame([(0,), (b["symbols"],), (b["symbols"] | b["bangs"],), (b["bangs"],), (0,)], "failed long")
    found = {r["rule"]: (r["n_failed"], r["n_only"], r["n_kept"]) for r in quality.ablations(entries).collect()}
    assert found["symbols"] == (2, 1, 2) and found["bangs"] == (2, 1, 2) and found["digits"] == (0, 0, 2)


def test_decontaminate(spark, docs, texts, nothing):
    some = WORD.findall(texts[0][1])
    items = [(1, " ".join(some[5:25])), (2, "ONE  two!"), (2, "ONE  two!"), (3, None), (4, "?!"), (5, prose(99, 12)), (None, " ".join(some[50:62]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    plain = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: plain.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = low(t)
        n = min(10, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[j : j + n])] |= {str(i)} - {"None"}
    want = []
    for i, t in texts:
        w, hit, ids = low(t), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    ids |= windows[tuple(w[j : j + n])]
        want.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    for part in (decontaminate.ITEM_BYTES, 100):  # the second: a benchmark in several parts
        assert listed(decontaminate.contamination(docs, bench, part), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(want, key=str)
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not x[5] for x in want)
    assert decontaminate.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(nothing, bench).count() == 0


def test_near_duplicates(docs, nothing):
    found = {(r["doc_id"], r["class_id"]) for r in near_dups.near_duplicates(docs).collect()}
    assert {(0, 0), (1, 0), (2, 0), (3, 3), (4, 4), (5, 4), (6, 6), (7, 7), (8, 8), (9, 9), (10, 10)} <= found
    kept = near_dups.one_of_each(docs)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and sorted(i for i in ids if i is not None) == [0, 3, 4, 6, 7, 8, 9, 10, 11, 12, 13] and ids.count(None) == 2
    assert near_dups.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("broadcast_rows", [0, 200_000])
def test_connected_against_union_find(spark, monkeypatch, broadcast_rows):
    shared_folder(spark)
    monkeypatch.setattr(near_dups, "BROADCAST_ROWS", broadcast_rows)
    rng = np.random.default_rng(5)
    links = [(i, i + 1) for i in range(100, 115)] + [(500, int(x)) for x in rng.integers(501, 560, 80)] + [(7, 7)]
    links += [(int(a), int(b)) for a, b in rng.integers(1000, 1060, (40, 2))]
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found = near_dups.connected(spark.createDataFrame(links, "a long, b long"))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert listed(found, "node", "class") == sorted(((x, root[x]) for x in linked), key=str)


def test_near_duplicates_against_all_pairs(spark):
    import pyarrow as pa

    shared_folder(spark)
    made = []
    for seed in range(12):
        words = prose(seed, 150).split()
        for k in range(6):  # copies that drift apart: some are linked only by way of others
            made.append(" ".join(words))
            words[20 * k : 20 * k + 3] = [f"x{seed}"] * 3
    rows, items, counts = near_dups.shingles(pa.array(made))
    sets = [tuple(x[rows == i][np.argsort(items[rows == i])] for x in (items, counts)) for i in range(len(made))]
    pairs = [(i, j) for j in range(len(made)) for i in range(j) if near_dups.probability_jaccard(sets[i], sets[j]) >= near_dups.SIMILARITY]
    first = list(range(len(made)))
    for _ in made:
        for i, j in pairs:
            first[i] = first[j] = min(first[i], first[j])
    found = near_dups.near_duplicates(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"))
    assert pairs and {r["doc_id"]: r["class_id"] for r in found.collect()} == dict(enumerate(first))


def test_signatures_estimate_the_exact_similarity():
    import pyarrow as pa

    gaps = []
    for seed in range(40):
        a = prose(seed, 200)
        b = a.split()
        b[10 : 10 + seed] = ["z"] * seed
        rows, items, counts = near_dups.shingles(pa.array([a, " ".join(b)]))
        owner = near_dups.signatures(rows, items, counts.astype(float), 2, 240)
        sets = [(np.sort(items[rows == k]), counts[rows == k][np.argsort(items[rows == k])]) for k in (0, 1)]
        gaps.append((owner[0] == owner[1]).mean() - near_dups.probability_jaccard(*sets))
    assert abs(np.mean(gaps)) < 0.02


def test_pii(spark, docs):
    samples = ["a@b.com_x@c.de y@z..q", "1.2.3.4.5.6.7.8 256.1.1.1", "é日 4111 1111 1111 1111", "+1 (017) 555-7713 +12", "", None, "9" * 30_000, "a" * 30_000]

    def luhn(x):
        return sum(n - 9 if n > 9 else n for n in (int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(x)))) % 10 == 0

    number = lambda m: re.sub(r"\D", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(number(m)) <= 19 and luhn(number(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(number(m)) <= 15),
    ]
    want = [
        (i, hashlib.sha256(",".join(f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, t or "") if ok(m[0])).encode()).hexdigest())
        for i, t in enumerate(samples)
    ]
    found = pii.findings(spark.createDataFrame(list(enumerate(samples)), "doc_id long, text string"))
    assert listed(found, "doc_id", "base_sha256") == sorted(want, key=str)
    more = pii.findings(spark.createDataFrame([(1, "bank IBAN DE89 3704 0044 0532 0130 00, call 555-123-4567")], "doc_id long, text string")).first()
    assert "iban:10:37" in more["spans"] and "local:" in more["spans"]
    assert pii.findings(docs).count() == docs.count()


def test_mixture(docs, nothing):
    found = mixture.mixed(docs).collect()
    assert len(found) == docs.count() and all(r["taken"] <= 2 * r["size"] for r in found)
    total = sum(r["size"] for r in found)
    by_source = {r["source_size"]: r["target"] for r in found}
    assert abs(sum(by_source.values()) - 1.5 * total) < 1e-6 * total and all(t <= 2 * s for s, t in by_source.items())
    assert sorted(map(str, found)) == sorted(map(str, mixture.mixed(docs).collect()))
    assert mixture.drawn(docs).columns == docs.columns
    assert mixture.mixed(nothing).count() == 0


def test_shards(docs, texts, nothing):
    found = shards.sharded(docs).collect()
    sizes = collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found)
    assert sizes == collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    slots = collections.defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    assert shards.with_shards(docs).columns == [c for c in docs.columns if c != "shard"] + ["shard", "slot"]
    assert shards.sharded(nothing).count() == 0


@pytest.mark.parametrize("sources", [("common_crawl_a", "common_crawl_b"), ("src100", "src109"), (None, "src1")])
def test_shards_tell_sources_with_a_common_beginning_apart(spark, sources):
    shared_folder(spark)
    rows = [(i, f"text {i:04d}", "en", sources[i % 2], 0, -1, "r", 9) for i in range(40)]
    found = shards.with_shards(spark.createDataFrame(rows, SCHEMA), 2).collect()
    assert len({(r["source"], r["shard"]) for r in found}) == 2 and len({r["shard"] for r in found}) == 2


def test_ranks_of_sources(spark):
    shared_folder(spark)
    values = [None, "", "a", "é", *[f"common_crawl_{i}" for i in range(3_000)]]
    rows = spark.createDataFrame([(v,) for v in values * 2], "source string")
    found = shards.ranks(rows, "source").orderBy("rank").collect()
    assert [r["source"] for r in found] == [None, *sorted(values[1:], key=str.encode)]
    assert [r["rank"] for r in found] == list(range(len(values)))


def test_token_ids(docs, texts, nothing):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    found = {r["start"]: r for r in token_ids.round_trip(docs, path).collect()}
    at, seen = 0, []
    while at in found:
        seen.append(found[at])
        at += found[at]["n_tokens"]
    assert len(seen) == len(texts)
    crc = lambda t: zlib.crc32(np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes())
    assert sorted((str(r["doc_id"]), r["ids_crc32"]) for r in seen) == sorted((str(i), crc(t)) for i, t in texts)
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in seen]
    assert ids == sorted(ids)
    pieces = token_ids.Pieces(path)
    odd = ["a  b", "a\n\nb", " a", "a ", "\n", "a b c", "don't 12\nx's <|endoftext|> y", "a\tb", "x \n y", "日本 語\nfoo"]
    assert pieces.encode(odd) == [pieces.ids(t) for t in odd]
    assert token_ids.round_trip(nothing, path).count() == 0


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 999])
def test_packing_round_trip(n):
    ranks = (np.random.default_rng(n).random(n) ** 8 * 2**32).astype(np.uint32)
    assert (token_ids.unpacked(*token_ids.packed(ranks), n) == ranks).all()


def test_html(spark):
    tree = html_text.grow(*html_text.training_table())
    page = """<html><head><title>T</title><script>var a="<p>x</p>";</script></head><body><header><a href=/>Site</a></header>
    <nav><ul><li><a>One</a><li><a>Two</a></ul></nav><div class="cookie-notice">We use cookies.</div><main><article><h1>Title &amp; more</h1>
    <p>First <b>para</b>\n with&nbsp;space.<p>Er.<p>Second<br>line<div class="ad">buy</div><form><label>Mail</label></form></article>
    <section id="comments"><article class="comment"><p>a reader says something long about it</p></article></section></main>
    <aside><p>Side text</p></aside><footer>foot</footer></body></html>"""
    assert html_text.main_text(page, tree) == "Title & more\n\nFirst para with space.\n\nEr.\n\nSecond line"
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p"), (3, "u", "<p"), (4, "u", "<article>x < y &am</article>" + "<" * 10_000)]
    found = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted((r["page_id"], r["n_chars"] == len(r["text"])) for r in found.collect()) == [(1, True), (2, True), (3, True), (3, True), (4, True)]


def test_toxicity(spark, nothing):
    shared_folder(spark)
    rows = [(i, prose(i, 60) + (" scumbag " if i % 4 == 0 else " ") + prose(1000 + i, 20), int(i % 4 == 0)) for i in range(400)]
    marked = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = marked.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int"))
    more = spark.createDataFrame([(1000, "a $cumb4g here"), (1001, "s c u m b a g"), (1002, None), (1003, ""), (None, "fine words"), (1002, None)], "doc_id long, text string")
    docs = marked.select("doc_id", "text").union(more)
    found = {r["doc_id"]: r for r in toxicity.scored(docs, labels).collect()}
    assert all(found[i]["predicted"] == toxic for i, _, toxic in rows)
    assert [found[i]["predicted"] for i in (1000, 1001, 1002, 1003, None)] == [1, 1, 0, 0, 0]
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    assert toxicity.scored(docs, labels.limit(0)).filter("predicted = 1").count() == 0
    assert toxicity.scored(nothing, labels).count() == 0


def spoken(spark):
    """400 texts of common words, each fourth with a telling one, and their labels."""
    words = "you are the a my of and people think that this very good people never read about time with some great plan".split()
    rng = np.random.default_rng(5)
    some = lambda n: " ".join(words[k] for k in rng.integers(0, len(words), n))
    rows = [(i, f"{some(40)} {('moron', 'stupid', 'idiot')[i // 4 % 3]} {some(20)}" if i % 4 == 0 else some(60), int(i % 4 == 0)) for i in range(400)]
    marked = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return marked.select("doc_id", "text"), marked.select("doc_id", "toxic")


def test_words_set_apart_keep_their_boundaries(spark):
    shared_folder(spark)
    docs, labels = spoken(spark)
    told = ["you are a m o r o n", "you are 5 s t u p i d", "that s t u p i d m o r o n", "i d i o t a y", "s*t*u*p*i*d", "m o r o n !", "s t u u u p 1 d"]
    fine = ["you are a p l a n", "p e o p l e r e a d", "a b c d e"]
    more = spark.createDataFrame(list(enumerate(told + fine, 1000)), "doc_id long, text string")
    found = {r["doc_id"]: r["predicted"] for r in toxicity.scored(docs.union(more), labels).filter("doc_id >= 1000").collect()}
    assert [found[1000 + i] for i in range(len(told + fine))] == [1] * len(told) + [0] * len(fine)
    read = toxicity.Restorer(toxicity.language_model(docs)).text
    assert re.findall("[a-z]+", read("s t u p i d m o r o n")) == ["stupid", "moron"]
    assert re.findall("[a-z]+", read("a m o r o n")) == ["a", "moron"]


def test_long_disguises_are_restored(spark):
    docs, labels = spoken(spark)
    long = " ".join("peoplereadaboutthetimewithsomegreatplanandthisverygoodmoron")
    more = spark.createDataFrame([(1000, "you are stu" + "u" * 70 + "pid"), (1001, long), (1002, "s" * 200_000 + "tupid")], "doc_id long, text string")
    found = {r["doc_id"]: r["predicted"] for r in toxicity.scored(docs.union(more), labels).filter("doc_id >= 1000").collect()}
    assert found == {1000: 1, 1001: 1, 1002: 1}
    read = toxicity.Restorer(toxicity.language_model(docs))
    assert read.text("stu" + "u" * 70 + "pid") == "stupid" and not read.known
    spelt = read.text("m0r" * 50_000 + " " + "a b " * 50_000 + "x").replace(" ", "")  # in one walk, without a limit
    assert spelt.startswith("mor") and spelt.endswith("abx") and len(spelt) > 200_000


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    judged = toxicity.scored(docs, labels).filter("held_out").join(labels, "doc_id")
    right = judged.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double"))).first()[0]
    assert right > 0.97


def test_pipeline_against_its_parts(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, folder).toPandas()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    toxic = {r["doc_id"] for r in toxicity.scored(docs, spark.read.parquet(f"{folder}/labels.parquet")).filter("predicted = 1").collect()}
    assert len(out) and not toxic & set(out["doc_id"])
    assert out["doc_id"].value_counts().max() <= 2 and out.drop_duplicates("doc_id")["text"].is_unique
    hit = {r["doc_id"] for r in decontaminate.contamination(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).filter("contaminated").collect()}
    assert not hit & set(out["doc_id"])
