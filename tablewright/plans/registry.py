"""Named queries over the given tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

DIGITS = 9


def query(name: str, sql: str | None = None, doubles: Sequence[str] = (), digits: int = DIGITS):
    """Register a query. Floating-point columns named in ``doubles`` are rounded on
    both sides, because sums depend on the order of their terms."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            # adding zero turns a negative zero into zero
            return df.withColumns({c: F.round(F.col(c).cast("double"), digits) + F.lit(0.0) for c in doubles})

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            if doubles:
                fixed = ", ".join(f"round(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in doubles)
                sql_text = f"SELECT * REPLACE ({fixed}) FROM ({sql.strip()}) AS result"
            else:
                sql_text = sql.strip()
            SQL[name] = sql_text
        return fn

    return register
