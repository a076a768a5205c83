"""Sharding by a k-d tree over metadata, with DataFrame functions only. Law: bytes.

Documents with equal text are one unit, so that copies stay together; a unit of more than a
64th of a shard's target is salted into parts of that size at most. The metadata of a unit
(bytes of the text, source, language) are those of its first document. Source and language
count by their rank among all distinct ones.

The tree starts with all units. At each level, every node is cut along its widest dimension,
measured against the whole collection, at the median weighted by bytes, until there are as
many leaves as shards. Medians are found by counting: bytes per interval of the node's
range, then again within the interval that holds the median, until that interval holds less
than a two-thousandth of the node. A place along a dimension is one number, the value
followed by a hash of the unit, so ties are cut as finely as anything else. The driver holds
a few numbers for each node and no unit.

Rows get their place in the shard from counts of (shard, bucket) and a row number within
the bucket, never within a whole shard.

Defined cases: a null text has no bytes and size 1; all null texts are one unit, the empty
texts another. Null sources and languages come before all others. Repeated rows keep their
own slots. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablewright.llm.tables import BROADCAST_ROWS, joined_small, pieces, stored

SHARDS = 16
SALT_PARTS = 64
BINS = 1024
ENOUGH = 2000
SLOT_ROWS = 100_000
DIMENSIONS = ("d_bytes", "d_source", "d_lang")
TIE = 1 << 15
RANK_BYTES = 8 << 20


def size_of(text: str = "text") -> Column:
    """Bytes of the text and one more."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def ranks(rows: DataFrame, name: str) -> DataFrame:
    """The distinct values of a column with their rank from 0 in binary order, null first. They are
    ordered in ranges, so there may be any number of them."""
    ranged = rows.select(name).distinct().repartitionByRange(name).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, f"{name}-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offset = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(name)) - 1
    return ranged.withColumn("within", within).join(offset, "part").select(name, (F.col("within") + F.col("offset")).alias("rank"))


def ranked(units: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """``units`` with the rank of their source or language, d_source or d_lang, in its stead."""
    side = stored(ranks(rows, name), f"{name}-ranks").withColumnRenamed(name, "value")
    count, size = side.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0))).first()
    side = F.broadcast(side) if count <= BROADCAST_ROWS and size <= RANK_BYTES else side
    joined = units.join(side, F.col(f"d_{name}").eqNullSafe(F.col("value")))
    return joined.drop("value", f"d_{name}").withColumnRenamed("rank", f"d_{name}")


def units_of(rows: DataFrame) -> DataFrame:
    """One row per (text, salt): bytes, tie hash and the dimensions as whole numbers."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "source", "lang"))
    made = rows.groupBy("digest", "salt").agg(F.sum("size").alias("weight"), F.max("size").alias("d_bytes"), first.alias("first"))
    made = made.select("digest", "salt", "weight", "d_bytes", F.col("first.source").alias("d_source"), F.col("first.lang").alias("d_lang"))
    made = ranked(ranked(made, rows, "source"), rows, "lang")
    tie = F.pmod(F.xxhash64("digest", "salt"), F.lit(TIE))
    return made.select("digest", "salt", "weight", tie.alias("tie"), *DIMENSIONS)


def place(dimension: str) -> Column:
    return F.col(dimension) * F.lit(TIE) + F.col("tie")


class Tree:
    """Cuts by node. Node numbers are those of a heap: the children of n are 2n and 2n + 1."""

    def __init__(self):
        self.cuts: dict[int, tuple[str, int]] = {}

    def node(self, levels: int) -> Column:
        """The node a unit is in after so many levels."""

        def below(node: int, depth: int) -> Column:
            if depth == levels or node not in self.cuts:
                return F.lit(node << (levels - depth))
            dimension, cut = self.cuts[node]
            return F.when(place(dimension) < F.lit(cut), below(2 * node, depth + 1)).otherwise(below(2 * node + 1, depth + 1))

        return below(1, 0)


def medians(units: DataFrame, wanted: dict[int, tuple[str, int, int, int]], shares: dict[int, float]) -> dict[int, int]:
    """node -> (dimension, least, greatest place, bytes) in, node -> cut out: bytes below the cut are
    nearly the node's share for its left child."""
    low = {n: w[1] for n, w in wanted.items()}
    high = {n: w[2] + 1 for n, w in wanted.items()}
    below = dict.fromkeys(wanted, 0)
    open_, cuts = set(wanted), {}
    while open_:
        step = {n: max(1, -(-(high[n] - low[n]) // BINS)) for n in open_}
        at = F.coalesce(*[F.when(F.col("node") == n, place(wanted[n][0])) for n in sorted(open_)])
        pick = lambda values: F.coalesce(*[F.when(F.col("node") == n, F.lit(values[n])) for n in sorted(open_)])  # noqa: E731, B023
        inside = units.withColumn("at", at).filter((F.col("at") >= pick(low)) & (F.col("at") < pick(high)))
        interval = F.floor((F.col("at") - pick(low)) / pick(step))
        counted = inside.groupBy("node", interval.alias("bin")).agg(F.sum("weight").alias("w"))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("bin"))
        aim = {n: wanted[n][3] * shares[n] - below[n] for n in open_}
        # the interval in which the median lies: the first that reaches it
        reached = counted.withColumn("upto", upto).filter(F.col("upto") >= pick(aim)).groupBy("node").agg(F.min(F.struct("bin", "upto", "w")).alias("m"))
        for row in reached.select("node", "m.*").collect():  # a row for each node
            n, edge = row["node"], low[row["node"]] + row["bin"] * step[row["node"]]
            under = below[n] + row["upto"] - row["w"]
            if row["w"] * ENOUGH <= wanted[n][3] or step[n] == 1:
                goal = wanted[n][3] * shares[n]
                cuts[n] = edge if goal - under <= under + row["w"] - goal else edge + step[n]
                open_.discard(n)
            else:
                low[n], high[n], below[n] = edge, min(high[n], edge + step[n]), under
    return cuts


def grown_tree(units: DataFrame, shards: int = SHARDS) -> Tree:
    """The cuts for a power of two of shards."""
    levels = (shards - 1).bit_length()
    tree, spans = Tree(), None
    for depth in range(levels):
        at = units.withColumn("node", tree.node(depth))
        ends = [f(d).alias(f"{name}_{d}") for d in DIMENSIONS for name, f in (("min", F.min), ("max", F.max))]
        places = [f(place(d)).alias(f"{name}_at_{d}") for d in DIMENSIONS for name, f in (("min", F.min), ("max", F.max))]
        nodes = at.groupBy("node").agg(F.sum("weight").alias("w"), *ends, *places).collect()  # a row for each node
        if spans is None:
            if not nodes:
                return tree
            spans = {d: max(1, nodes[0][f"max_{d}"] - nodes[0][f"min_{d}"]) for d in DIMENSIONS}
        wanted = {}
        for row in nodes:
            widest = max(DIMENSIONS, key=lambda d: (row[f"max_{d}"] - row[f"min_{d}"]) / spans[d])  # noqa: B023
            wanted[row["node"]] = (widest, row[f"min_at_{widest}"], row[f"max_at_{widest}"], row["w"])
        cuts = medians(at, wanted, dict.fromkeys(wanted, 0.5))
        tree.cuts |= {n: (wanted[n][0], cut) for n, cut in cuts.items()}
    return tree


def assigned(docs: DataFrame, shards: int = SHARDS, keep_row: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; `row` with all columns of
    ``docs`` if asked for."""
    whole = [F.struct("*").alias("row")] if keep_row else []
    marks = [F.col("doc_id"), size_of().alias("size"), F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).alias("text_crc32")]
    rows = docs.select(*whole, *marks, F.xxhash64("text").alias("digest"), "source", "lang")
    narrow = stored(rows.drop("row"), "sizes")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    limit = max(1, total // (shards * SALT_PARTS))
    heavy = narrow.groupBy("digest").agg(F.sum("size").alias("w"), F.count("*").alias("n")).filter((F.col("w") > limit) & (F.col("n") > 1))
    # of these there are fewer than shards * SALT_PARTS
    salts = F.broadcast(stored(heavy.select("digest", F.ceil(F.col("w") / limit).alias("salts")), "heavy"))
    spot = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("salts")), F.lit(0)).cast("bigint")
    salted = lambda df: df.join(salts, "digest", "left").withColumn("salt", spot).drop("salts")
    units = stored(units_of(salted(narrow)), "units")
    tree = grown_tree(units, shards)
    levels = (shards - 1).bit_length()
    leaf = units.select("digest", "salt", (tree.node(levels) - (1 << levels)).cast("int").alias("shard"))
    placed = salted(rows).join(leaf, ["digest", "salt"])

    # slots: rows before the bucket in its shard, then the number within the bucket
    buckets = pieces(narrow, F.lit(1), SLOT_ROWS * shards, 1)
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("digest", "doc_id"), F.lit(buckets)))
    small = salted(narrow).join(leaf, ["digest", "salt"]).withColumn("bucket", F.pmod(F.xxhash64("digest", "doc_id"), F.lit(buckets)))
    counts = small.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"), "offsets")
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "digest")) - 1
    out = joined_small(placed.withColumn("within", within), offsets, ["shard", "bucket"])
    return out.select(*(["row"] if keep_row else []), "doc_id", "size", "text_crc32", "shard", (F.col("within") + F.col("offset")).cast("bigint").alias("slot"))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The contract's columns."""
    none = F.lit(None).cast("int").alias("grown_shard")
    return assigned(docs, shards).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", none)


def with_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows of ``docs`` with `shard` and `slot`; columns of these names are replaced."""
    out = assigned(docs, shards, keep_row=True)
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")
