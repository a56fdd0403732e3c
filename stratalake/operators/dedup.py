"""Duplicate business keys: find them, or keep the latest row of each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ORDERABLE = (T.AtomicType, T.ArrayType, T.StructType)


def _remaining(df: DataFrame, used: set[str]) -> list[str]:
    return sorted(
        f.name
        for f in df.schema.fields
        if f.name not in used
        and isinstance(f.dataType, _ORDERABLE)
        and not isinstance(f.dataType, T.VariantType)
    )


def latest_wins(
    df: DataFrame,
    keys: Sequence[str],
    recency: str | Sequence[str] = "ingested_at",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the newest row per key.

    Rows equal in ``recency`` are ranked by ``ties`` (by default all remaining
    columns), so the winner does not depend on row order. The ``rank = 1``
    filter lets Spark drop losers on the map side: a key with any number of
    copies reaches its reducer as at most one row per map task.
    """
    recency = [recency] if isinstance(recency, str) else list(recency)
    if ties is None:
        ties = _remaining(df, {*keys, *recency})
    order: list[Column] = [F.col(c).desc() for c in (*recency, *ties)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count ``cnt``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


def append_then_dedup(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    recency: str = "ingested_at",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The state of an append-only table after adding ``batch`` and removing duplicate keys.

    Pass only the partitions the batch touches as ``target``; rows elsewhere
    cannot share a key with the batch.
    """
    both = target.unionByName(batch.select(*target.columns))
    return latest_wins(both, keys, recency, ties)
