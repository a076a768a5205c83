"""Size-checked broadcasting.

A side is broadcast only after its rows and bytes have been measured; beyond the
bound the frame goes back unchanged and Spark joins by shuffle, splitting skewed
partitions at run time.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import durable

MAX_ROWS = 100_000
MAX_BYTES = 32 << 20


def small_table(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> pa.Table | None:
    """The rows of a frame that fits the bound, None for one that does not."""
    head = df.limit(max_rows + 1).persist()
    try:
        # the size is known before a row reaches the driver; JSON stands for any type
        size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long")), F.lit(0))
        rows, held = head.agg(F.count(F.lit(1)), size).first()
        return None if rows > max_rows or held > max_bytes else head.toArrow()
    finally:
        head.unpersist()


def pinned(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``df`` as a broadcast relation when it fits the bound, else ``df`` itself."""
    table = small_table(df, max_rows, max_bytes)
    if table is None:
        return df
    spark = df.sparkSession
    if table.num_rows == 0:
        return F.broadcast(spark.createDataFrame([], df.schema))
    return F.broadcast(spark.createDataFrame(table, df.schema))


def fixed(df: DataFrame) -> DataFrame:
    """``df`` computed once: as a broadcast relation within the bound, else stored."""
    side = pinned(df)
    return durable(df) if side is df else side


def lookup(
    df: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    weight: str | None = None,
    max_rows: int = MAX_ROWS,
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """Join ``df`` with a table that is unique on ``on``.

    Within the bound this is a map-side join. Beyond it the join shuffles, and
    ``weight`` names the column of ``small`` that tells how many rows of ``df`` have the
    key: a key with more than ``rows_per_task`` gets that many copies under different
    salts, so that its rows go to several tasks. The column is not added to the result
    unless it is among the wanted ones anyway.
    """
    probe = pinned(small, max_rows)
    if probe is not small:
        return df.join(probe, on, how)
    if weight is None:
        return df.join(small, on, how)
    salts = F.greatest(F.ceil(F.col(weight) / rows_per_task), F.lit(1))
    hot = pinned(small.filter(F.col(weight) > rows_per_task).select(*on, salts.alias("_salts")))
    spot = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_salts"))
    salted = df.join(hot, on, "left").withColumn("_salt", F.coalesce(spot, F.lit(0).cast("long"))).drop("_salts")
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def task_count(df: DataFrame) -> int:
    """Tasks to spread row-multiplying work over; a given number is not coalesced."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
