"""Compare a Spark result with DuckDB's, row by row, ignoring order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """A description of how the results differ, or None."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    actual = _rows(spark_df.columns, spark_df.collect())
    if actual == expected:
        return None
    missing, extra = expected - actual, actual - expected
    return (
        f"{actual.total()} rows, expected {expected.total()}; {missing.total()} missing such as "
        f"{list(missing)[:3]}; {extra.total()} extra such as {list(extra)[:3]}"
    )
