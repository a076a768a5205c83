"""Vocabulary, encoding, padding, packing and sequence statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.functions import text as tx
from tablewright.functions.batches import pieces
from tablewright.operators.scan import RowNumber, Running, scan
from tablewright.operators.sized import lookup, small_table
from tablewright.session import durable

#: rows that one window may number
WINDOW_ROWS = 1_000_000
#: tokens that a task looks up at once
PIECE_TOKENS = 1 << 18
SPECIALS = ("<pad>", "<unk>", "<s>", "</s>")
PERCENTILES = (0, 25, 50, 75, 90, 95, 99, 100)


def build_vocab(
    df: DataFrame, column: str, size: int | None = 32_000, min_count: int = 1, specials: Sequence[str] = SPECIALS
) -> DataFrame:
    """``(token, token_id, n)`` by falling count, then token; special tokens come first."""
    counts = (
        df.select(F.explode(tx.words(column)).alias("token"))
        .filter(~F.col("token").isin(*specials))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_count)
    )
    order = [F.col("n").desc(), F.col("token").asc()]
    if size is None or size > WINDOW_ROWS:
        ranked = scan(durable(counts), [], [-F.col("n"), "token"], RowNumber("rank"))
        ranked = ranked if size is None else ranked.filter(F.col("rank") <= size - len(specials))
    else:
        # the vocabulary size bounds the rows that reach this window
        top = counts.orderBy(*order).limit(max(size - len(specials), 0))
        ranked = top.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    learned = ranked.select(
        "token", (F.col("rank") + len(specials) - 1).cast("int").alias("token_id"), "n"
    )
    fixed = df.sparkSession.createDataFrame(
        [(t, i, 0) for i, t in enumerate(specials)], "token string, token_id int, n long"
    )
    return fixed.unionByName(learned)


def _truncate(tokens: Column, room: int, side: str) -> Column:
    if side == "right":
        return F.slice(tokens, 1, room)
    return F.when(F.size(tokens) > room, F.slice(tokens, -room, room)).otherwise(tokens)


def _vocab_lookup(df: DataFrame, table: pa.Table, unknown: int) -> Callable:
    shared = df.sparkSession.sparkContext.broadcast(
        (table.column("token").combine_chunks(), table.column("token_id").combine_chunks())
    )

    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens, ids = shared.value
        known = dict(zip(tokens.to_pylist(), ids.to_pylist()))  # hashed once for a task
        for batch in batches:
            yield from _ids_in_pieces(batch, known, unknown)
            del batch  # gone before the next one is read

    return to_ids


def _ids_in_pieces(batch: pa.ListArray, known: dict[str, int], unknown: int) -> Iterator[pa.ListArray]:
    for piece in pieces(batch, batch.value_lengths().to_numpy(), PIECE_TOKENS):
        yield _ids_of(piece, known, unknown)


def _ids_of(lists: pa.ListArray, known: dict[str, int], unknown: int) -> pa.ListArray:
    """The ids of token lists; distinct tokens are looked up once."""
    flat = lists.flatten().dictionary_encode()
    found = pa.array([known.get(t, unknown) for t in flat.dictionary.to_pylist()], pa.int32())
    offsets = pc.subtract(lists.offsets, lists.offsets[0])
    return pa.ListArray.from_arrays(offsets, found.take(flat.indices))


def encode(
    df: DataFrame,
    column: str,
    vocab: DataFrame,
    row_id: str = "row_id",
    max_length: int | None = 2048,
    truncation_side: str = "right",
    add_bos: bool = False,
    add_eos: bool = False,
    specials: Sequence[str] = SPECIALS,
    max_vocab_rows: int = 1_000_000,
) -> DataFrame:
    """``input_ids`` and ``attention_mask`` for each text.

    A vocabulary within the bound is shipped to the tasks and looked up per Arrow
    batch without a shuffle; a larger one is joined. ``max_length`` None keeps all tokens.
    """
    unknown = list(specials).index("<unk>")
    extra = int(add_bos) + int(add_eos)
    tokens = tx.words(column)
    if max_length is not None:
        if max_length - extra < 1:
            raise ValueError("max_length leaves no room for tokens")
        tokens = _truncate(tokens, max_length - extra, truncation_side)
    kept = [c for c in df.columns if c != column]
    table = small_table(vocab.select("token", "token_id"), max_vocab_rows, 256 << 20)
    if table is not None:
        to_ids = _vocab_lookup(df, table, unknown)
        body = df.withColumn("_ids", to_ids(tokens))
    else:
        flat = df.select(row_id, F.posexplode(tokens).alias("_at", "token"))
        ids = (
            lookup(flat, vocab.select("token", "token_id", "n"), ["token"], weight="n", max_rows=1)
            .groupBy(row_id)
            .agg(F.array_sort(F.collect_list(F.struct("_at", F.coalesce("token_id", F.lit(unknown)).alias("id")))).alias("_s"))
            .select(row_id, F.transform("_s", lambda x: x["id"]).alias("_ids"))
        )
        body = df.join(ids, row_id, "left").withColumn(
            "_ids", F.coalesce("_ids", F.array().cast("array<int>"))
        )
    start = F.array(F.lit(list(specials).index("<s>"))) if add_bos else F.array().cast("array<int>")
    end = F.array(F.lit(list(specials).index("</s>"))) if add_eos else F.array().cast("array<int>")
    out = body.select(*kept, F.concat(start, "_ids", end).alias("input_ids")) if extra else body.select(
        *kept, F.col("_ids").alias("input_ids")
    )
    return out.withColumn("attention_mask", F.transform("input_ids", lambda x: F.lit(1)))


def encode_with(df: DataFrame, column: str, tokenizer: Callable[[str], Sequence[int]], max_length: int | None = None) -> DataFrame:
    """Encoding by a caller's own tokenizer, batched through Arrow; ``max_length`` cuts the ids if given."""
    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: list(tokenizer(t or ""))[:max_length])

    return df.withColumn("input_ids", run(F.col(column))).withColumn(
        "attention_mask", F.transform("input_ids", lambda x: F.lit(1))
    )


def assign_batches(df: DataFrame, size: int, row_id: str = "row_id", drop_last: bool = False) -> DataFrame:
    """Consecutive batches of ``size`` rows in id order. The rows, often encoded ones, are stored first."""
    df = durable(df)
    numbered = scan(df, [], [row_id], RowNumber("_rn"))
    batch = F.floor((F.col("_rn") - 1) / size).cast("long")
    out = numbered.withColumn("batch", batch)
    if drop_last:
        out = out.filter(F.col("batch") < df.count() // size)
    return out.drop("_rn")


def pad(
    df: DataFrame, batch: str = "batch", multiple_of: int = 8, side: str = "right", pad_id: int = 0
) -> DataFrame:
    """Ids and mask padded to the longest of the batch, rounded up."""
    longest = F.max(F.size("input_ids")).over(Window.partitionBy(batch))
    width = (F.ceil(longest / multiple_of) * multiple_of).cast("int")

    def grown(name: str, fill: int) -> Column:
        gap = F.array_repeat(F.lit(fill), F.col("_width") - F.size("input_ids"))
        return (F.concat(name, gap) if side == "right" else F.concat(gap, name)).alias(name)

    kept = [c for c in df.columns if c not in ("input_ids", "attention_mask")]
    return df.withColumn("_width", width).select(*kept, grown("input_ids", pad_id), grown("attention_mask", 0))


def build_labels(df: DataFrame, ignore: int = -100) -> DataFrame:
    """Labels equal to the ids, with ``ignore`` where the mask is zero."""
    return df.withColumn(
        "labels",
        F.zip_with("input_ids", "attention_mask", lambda i, m: F.when(m == 1, i).otherwise(F.lit(ignore))),
    )


def pack_sequences(
    df: DataFrame, block: int, row_id: str = "row_id", shard: Sequence[str] = (), drop_last: bool = False
) -> DataFrame:
    """Token lists joined in id order and cut into blocks of equal size.

    The lists are stored, because the scan reads their lengths before it moves them, once. Each list is
    then sliced at the block bounds, and a block never holds more than ``block`` tokens.
    """
    shard = list(shard)
    df = durable(df.select(*shard, row_id, "input_ids"))
    sized = df.withColumn("_size", F.size("input_ids").cast("long")).filter("_size > 0")
    placed = scan(sized, shard, [row_id], Running("_start", "sum", F.col("_size"), inclusive=False))
    placed = placed.withColumn("_start", F.coalesce("_start", F.lit(0).cast("long")))
    first = F.floor(F.col("_start") / block)
    last = F.floor((F.col("_start") + F.col("_size") - 1) / block)
    cut = (
        placed.select(*shard, "_start", "_size", "input_ids", F.explode(F.sequence(first, last)).alias("block"))
        .withColumn("_from", F.greatest(F.col("block") * block, F.col("_start")))
        .withColumn("_to", F.least((F.col("block") + 1) * block, F.col("_start") + F.col("_size")))
        .select(
            *shard,
            "block",
            "_from",
            F.slice(
                "input_ids",
                (F.col("_from") - F.col("_start") + 1).cast("int"),
                (F.col("_to") - F.col("_from")).cast("int"),
            ).alias("_ids"),
        )
    )
    packed = cut.groupBy(*shard, "block").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_from", "_ids"))), lambda x: x["_ids"])).alias("input_ids")
    )
    return packed.filter(F.size("input_ids") == block) if drop_last else packed


def percentile_list(value: str | Column, points: Sequence[float]) -> Column:
    """Exact percentiles of a column with few distinct values, such as a length."""
    v = F.col(value) if isinstance(value, str) else value
    return F.percentile(v, F.array(*[F.lit(p / 100.0) for p in points]))


def analyze_sequences(df: DataFrame, limit: int = 2048, points: Sequence[float] = PERCENTILES) -> DataFrame:
    n = F.size("input_ids")
    stats = df.agg(
        F.count(F.lit(1)).alias("n_sequences"),
        F.avg(n).alias("mean"),
        F.stddev_pop(n).alias("std"),
        F.min(n).alias("min"),
        F.max(n).alias("max"),
        percentile_list(n, points).alias("_p"),
        F.count_if(n >= limit).alias("at_limit"),
        F.avg((n >= limit).cast("double")).alias("at_limit_ratio"),
    )
    return stats.select(
        "*", *[F.col("_p")[i].alias(f"p{p:g}".replace(".", "_")) for i, p in enumerate(points)]
    ).drop("_p")


def count_statistics(df: DataFrame, size: Column, suffix: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean, standard deviation, bounds and median of a count."""
    return df.groupBy(*by).agg(
        F.avg(size).alias(f"mean_{suffix}"),
        F.stddev_pop(size).alias(f"std_{suffix}"),
        F.min(size).alias(f"min_{suffix}"),
        F.max(size).alias(f"max_{suffix}"),
        F.percentile(size, F.lit(0.5)).alias(f"median_{suffix}"),
    )


def token_statistics(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return count_statistics(df, F.size("input_ids"), "tokens", by)
