"""Small helpers shared by the operators: inputs, stored intermediates and their sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import fresh_folder

#: a side is broadcast only up to so many rows of fixed width
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps start from the files."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(df: DataFrame, weight: Column, each: int, least: int) -> int:
    """How many parts of ``each`` units of ``weight`` the rows make, ``least`` at least."""
    total = df.agg(F.sum(weight).alias("n")).first()["n"] or 0
    return max(least, -(-int(total) // each))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def joined_small(df: DataFrame, side: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a stored side of fixed-width columns: broadcast if its counted rows are few."""
    few = side.count() <= BROADCAST_ROWS
    return df.join(F.broadcast(side) if few else side, on, how)
