"""Registration of queries together with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import rounded

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: Sequence[str] = ()) -> Callable[[Query], Query]:
    """Register a query; ``views`` are the CTEs its SQL reads."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = (f"WITH {', '.join(views)} " if views else "") + sql.strip()
        return fn

    return register


def r(expression: str, digits: int = 4) -> str:
    """SQL twin of ``rounded``."""
    return f"CAST(round(CAST({expression} AS DECIMAL(30,8)), {digits}) AS DOUBLE)"


def rd(c: str | Column, digits: int = 4) -> Column:
    """Rounded column that keeps its name."""
    if isinstance(c, str):
        return rounded(F.col(c), digits).alias(c)
    return rounded(c, digits)


def round_all(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column."""
    return df.select(*[rd(c, digits) if t == "double" else F.col(c) for c, t in df.dtypes])
