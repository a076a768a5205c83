"""Mixing sources to target weights, with DataFrame functions only.

Targets. Sources in code-point order, null last, weigh `WEIGHTS` in turn and share `SHARE` of
all words; no source gives more than `REPEATS` times its own words, and what it can't give
is shared by weight among the others until none is above: target = min(cap, level * weight)
with the one level at which the targets sum up.

Drawing. Each source's documents lie in blocks by a seeded hash of their id, at most
`BLOCKS` to a source, so a block of a hot source is a small share of it. In block order the
source gives whole rounds of all blocks, then blocks up to its target, and of the last block
the documents, in hash order, that still fit.

Output shards. The blocks drawn of each source are its quota. A binary tree deals quotas to
shards: at each node the blocks that go left are drawn from a multivariate hypergeometric
distribution, source by source, each by inversion of its hypergeometric distribution, so
every shard gets an equal number of blocks and every block one shard. A shard then takes the
next run of each source's permuted blocks, and orders its documents by another hash.

Defined cases: null and empty texts have no words and are taken with their block; a null
source is a source of its own, with the last weight; without any word all targets are 0 and
each document is taken once per whole round of none, that is, not at all. Documents with
equal id share their hash; repeated rows are taken alike. Seeds make reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.tables import joined_small, shuffle_width, stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
REPEATS = 2
BLOCKS = 1024
BLOCK_WORDS = 20_000
SHARDS = 16
SEED = 4
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) fixed by ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def numbered(sources: DataFrame) -> DataFrame:
    """Sources with their place in code-point order, null last. They are numbered within
    groups by their first two characters, and groups are few."""
    head = F.substring(F.coalesce("source", F.lit("")), 1, 2)
    parts = sources.withColumn("head", head).withColumn("none", F.col("source").isNull())
    before = Window.orderBy("none", "head").rowsBetween(Window.unboundedPreceding, -1)
    offset = parts.groupBy("none", "head").agg(F.count("*").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("none", "head").orderBy("source")) - 1
    return parts.withColumn("place", place).join(offset.drop("n"), ["none", "head"]).withColumn("place", F.col("place") + F.col("offset")).drop("none", "head", "offset")


def targets(sources: DataFrame, share: float = SHARE, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """source, source_size -> with place and target. The level rises until the sources
    below their cap take exactly what is left; each step is one small aggregation."""
    weight = F.array(*[F.lit(w) for w in weights])[(F.col("place") % len(weights)).cast("int")]
    table = stored(numbered(sources).withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(repeats)), "sources")
    total = share * float(table.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("weight")
        row = table.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not row[1]:
            break
        risen = (total - row[0]) / row[1]
        if risen <= level * (1 + 1e-12):
            break
        level = risen
    return table.withColumn("target", F.least("cap", F.lit(level) * F.col("weight"))).drop("cap")


def hypergeometric(draws: Column, good: Column, total: Column, u: Column) -> Column:
    """Good ones among ``draws`` of ``total``, of which ``good`` are good, by inversion at ``u``.

    Probabilities are taken relative to the mode, from which both sides fall off, so nothing
    underflows; the walk goes over the values that are possible.
    """
    low, high = F.greatest(F.lit(0), draws - (total - good)), F.least(draws, good)
    mode = F.least(high, F.greatest(low, F.floor((draws + 1) * (good + 1) / (total + 2))))
    up = lambda k: (good - k) * (draws - k) / ((k + 1) * (total - good - draws + k + 1))
    step = lambda s, k, ratio: F.struct((s["p"] * ratio).alias("p"), F.concat(s["all"], F.array(s["p"] * ratio)).alias("all"))
    start = lambda: F.struct(F.lit(1.0).alias("p"), F.array().cast("array<double>").alias("all"))
    rises = F.when(high > mode, F.aggregate(F.sequence(mode, high - 1), start(), lambda s, k: step(s, k, up(k)), lambda s: s["all"])).otherwise(F.array().cast("array<double>"))
    falls = F.when(mode > low, F.aggregate(F.sequence(mode - 1, low, F.lit(-1).cast("bigint")), start(), lambda s, k: step(s, k, 1.0 / up(k)), lambda s: s["all"])).otherwise(F.array().cast("array<double>"))
    chances = F.concat(F.reverse(falls), F.array(F.lit(1.0)), rises)
    aim = u * F.aggregate(chances, F.lit(0.0), lambda s, p: s + p)
    walk = F.aggregate(
        chances,
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("bigint").alias("k")),
        lambda s, p: F.struct((s["sum"] + p).alias("sum"), (s["k"] + F.when(s["sum"] + p <= aim, 1).otherwise(0)).alias("k")),
        lambda s: s["k"],
    )
    return F.least(high, low + walk)


def split(quotas: Column, left: Column, node: Column, seed: int) -> Column:
    """Quotas (source place, blocks) of a node -> the part of each that goes left, when
    ``left`` blocks of all go left: a multivariate hypergeometric draw."""
    whole = F.aggregate(quotas, F.lit(0).cast("bigint"), lambda s, q: s + q["blocks"])
    zero = F.struct(whole.alias("total"), left.cast("bigint").alias("draws"), F.array().cast("array<struct<place:bigint,blocks:bigint>>").alias("out"))

    def draw(state: Column, quota: Column) -> Column:
        u = uniform(F.lit(seed), node, quota["place"])
        taken = hypergeometric(state["draws"], quota["blocks"], state["total"], u)
        # the draw is bound once: it stands in a one-element array
        return F.transform(
            F.array(taken),
            lambda t: F.struct(
                (state["total"] - quota["blocks"]).alias("total"),
                (state["draws"] - t).alias("draws"),
                F.concat(state["out"], F.array(F.struct(quota["place"].alias("place"), t.cast("bigint").alias("blocks")))).alias("out"),
            ),
        )[0]

    return F.aggregate(quotas, zero, draw, lambda s: s["out"])


def shard_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """place, blocks -> place, shard, blocks and first, the run of the source's blocks that
    the shard takes. The quotas of a node are one row, two numbers for each source."""
    row = F.sort_array(F.collect_list(F.struct(F.col("place").cast("bigint").alias("place"), F.col("blocks").cast("bigint").alias("blocks"))))
    nodes = quotas.agg(row.alias("quotas")).select(F.lit(0).alias("low"), F.lit(shards).alias("high"), "quotas")
    while shards > 1:
        width = F.col("high") - F.col("low")
        half = F.floor(width / 2)
        whole = F.aggregate("quotas", F.lit(0).cast("bigint"), lambda s, q: s + q["blocks"])
        left = split(F.col("quotas"), F.floor(whole * half / width), F.col("low") * 1_000_003 + F.col("high"), seed)
        nodes = nodes.withColumn("left", F.when(width > 1, left))
        rest = F.zip_with("quotas", "left", lambda q, t: F.struct(q["place"].alias("place"), (q["blocks"] - t["blocks"]).alias("blocks")))
        middle = (F.col("low") + half).cast("int")
        children = F.array(F.struct(F.col("low").alias("low"), middle.alias("high"), F.col("left").alias("quotas")), F.struct(middle.alias("low"), F.col("high"), rest.alias("quotas")))
        own = F.array(F.struct("low", "high", "quotas"))
        nodes = nodes.select(F.explode(F.when(width > 1, children).otherwise(own)).alias("n")).select("n.*")
        nodes = stored(nodes, "quotas")
        shards = -(-shards // 2)
    runs = nodes.select(F.col("low").alias("shard"), F.explode("quotas").alias("q")).select("shard", "q.*")
    before = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return runs.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0)))


def plan(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sizes of the documents, the sources with their targets, and what is taken of each
    block: whole rounds, the documents of one more round up to a hash, and the shards."""
    sized = docs.select("doc_id", "source", words().alias("size"), F.xxhash64(F.lit(seed), "doc_id").alias("key"))
    sized = stored(sized, "sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    sources = sources.withColumn("n_blocks", F.greatest(F.lit(1), F.least(F.lit(BLOCKS), F.ceil(F.col("source_size") / BLOCK_WORDS))).cast("bigint"))
    sources = stored(sources.withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")), "targets")
    # the null source joins as any other
    known = sources.select(F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none"), "place", "source_size", "target", "n_blocks", "rounds")
    named = sized.withColumn("name", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull())
    rows = joined_small(named, known, ["name", "none"]).drop("name", "none")
    u = F.shiftrightunsigned("key", 11) / F.lit(float(1 << 53))
    rows = rows.withColumn("block", F.floor(u * F.col("n_blocks")))

    # at most BLOCKS rows for each source
    blocks = rows.groupBy("place", "block").agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("rounds").alias("rounds"))
    order = Window.partitionBy("place").orderBy("block")
    blocks = blocks.withColumn("number", F.row_number().over(order) - 1).withColumn("held", F.count("*").over(Window.partitionBy("place")))
    blocks = blocks.withColumn("before", F.sum("words").over(order) - F.col("words"))
    blocks = blocks.withColumn("left", F.col("target") - F.col("rounds") * F.col("source_size") - F.col("before"))
    blocks = stored(blocks.withColumn("more", (F.col("left") > 0) & (F.col("rounds") < REPEATS)).withColumn("cut", F.col("more") & (F.col("left") < F.col("words"))), "blocks")

    # in the one block of each source that is not taken whole: hash order up to what is left
    inner = joined_small(rows.select("place", "block", "size", "key"), blocks.filter("cut").select("place", "block", "left"), ["place", "block"])
    upto = F.sum("size").over(Window.partitionBy("place").orderBy("key"))
    last = inner.withColumn("upto", upto).filter(F.col("upto") - F.col("size") / 2 <= F.col("left")).groupBy("place").agg(F.max("key").alias("last_key"))
    blocks = blocks.join(last, "place", "left")

    # every round's blocks are drawn one after another: a source's draws are 0, 1, 2, ...
    quotas = blocks.groupBy("place").agg((F.max("rounds") * F.max("held") + F.sum(F.col("more").cast("bigint"))).alias("blocks"))
    runs = shard_quotas(quotas, shards, seed)
    draws = blocks.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rounds") - 1 + F.col("more").cast("bigint"))).alias("turn")).filter("turn >= 0 AND (turn < rounds OR more)")
    draws = draws.withColumn("draw", F.col("turn") * F.col("held") + F.col("number"))
    at = (F.col("d.place") == F.col("r.place")) & (F.col("d.draw") >= F.col("r.first")) & (F.col("d.draw") < F.col("r.first") + F.col("r.blocks"))
    dealt = draws.alias("d").join(runs.alias("r"), at).select("d.place", "d.block", "d.turn", "d.rounds", "d.cut", "d.last_key", "r.shard")
    taken = dealt.groupBy("place", "block").agg(F.max("cut").alias("cut"), F.max("rounds").alias("whole"), F.first("last_key").alias("last_key"), F.sort_array(F.collect_list(F.struct("turn", "shard"))).alias("turns"))
    return rows, sources, stored(taken, "taken")


def decided(rows: DataFrame, taken: DataFrame) -> DataFrame:
    """Documents with the shards that take them, one entry for each time."""
    joined = rows.join(F.broadcast(taken) if taken.count() <= 100_000 else taken, ["place", "block"], "left")
    within = lambda t: (t["turn"] < F.col("whole")) | ~F.col("cut") | F.coalesce(F.col("key") <= F.col("last_key"), F.lit(False))
    shards = F.transform(F.filter("turns", within), lambda t: t["shard"])
    return joined.withColumn("shards", F.coalesce(shards, F.array().cast("array<int>")))


def mixed(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes."""
    rows, _, taken = plan(docs, shards, seed)
    return decided(rows, taken).select("doc_id", "size", "source_size", "target", (F.size("shards") * F.col("size")).cast("bigint").alias("taken"), "shards")


def drawn(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, all columns, as often as the mix takes them, by shard and, in a
    shard, in hash order."""
    _, sources, taken = plan(docs, shards, seed)
    rows = docs.select(F.struct("*").alias("row"), F.col("source").alias("own_source"), F.xxhash64(F.lit(seed), "doc_id").alias("key"))
    known = sources.select(F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none"), "place", "n_blocks")
    named = rows.withColumn("name", F.coalesce("own_source", F.lit(""))).withColumn("none", F.col("own_source").isNull())
    named = joined_small(named, known, ["name", "none"])
    named = named.withColumn("block", F.floor(F.shiftrightunsigned("key", 11) / F.lit(float(1 << 53)) * F.col("n_blocks")))
    out = decided(named, taken).select("row", "key", F.posexplode("shards").alias("turn", "shard"))
    order = F.xxhash64(F.lit(seed + 1), "key", "turn")
    # a shard is dealt to several tasks, each of which shuffles its part
    out = out.repartition("shard", F.pmod(order, F.lit(shuffle_width(docs.sparkSession))))
    return out.sortWithinPartitions("shard", order).select("row.*")
