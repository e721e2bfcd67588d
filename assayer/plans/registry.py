"""Registry of the runnable queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; ``sql`` is the same result in plain SQL."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def rnd(col: Column | str, digits: int = 6) -> Column:
    """Round and drop the sign of zero, so two engines print the same number."""
    return F.round(F.col(col) if isinstance(col, str) else col, digits) + F.lit(0.0)


def sql_rnd(expr: str, digits: int = 6) -> str:
    return f"(ROUND({expr}, {digits}) + 0.0)"


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: rnd(c, digits) for c in cols})
