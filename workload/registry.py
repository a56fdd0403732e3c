"""Where the query modules put their entries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that gives the same result."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} defined twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(column: str | Column, digits: int = 6, name: str | None = None) -> Column:
    """Doubles are compared after rounding: engines add in different orders."""
    col = F.col(column) if isinstance(column, str) else column
    return F.round(col, digits).alias(name or column)


def text(column: str, name: str | None = None) -> Column:
    """Dates and times are compared as text."""
    return F.col(column).cast("string").alias(name or column)


def moment(column: str, name: str | None = None) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name or column)


def whole(column: str, name: str | None = None) -> Column:
    return F.col(column).cast("bigint").alias(name or column)
