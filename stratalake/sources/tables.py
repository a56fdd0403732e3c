"""Typed, partitioned catalog tables: create, read the touched part, publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settings


def _levels(partition: str | Sequence[str]) -> list[str]:
    return [partition] if isinstance(partition, str) else list(partition)


def create_table(
    spark: SparkSession, name: str, columns: Mapping[str, str], partition: str | Sequence[str] | None,
    provider: str = "parquet", location: str | None = None,
) -> None:
    """Create the database (below ``location``, if given) and the table unless they exist."""
    if "." in name:
        database = name.rsplit(".", 1)[0]
        at = f"LOCATION '{location}/{database}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} {at}")
    body = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in _levels(partition))})" if partition else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING {provider} {by}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def register_partitions(spark: SparkSession, name: str) -> None:
    """Make the catalog see folders that were written beside it."""
    spark.catalog.recoverPartitions(name)


def _for_table(df: DataFrame, name: str) -> DataFrame:
    """Columns in table order, which is what inserting by position needs."""
    return df.select(*df.sparkSession.table(name).columns)


def append(df: DataFrame, name: str, partition: str | None = None) -> None:
    """Add rows; with ``partition``, gathered into few files of each."""
    if partition:
        df = df.hint("rebalance", partition)
    _for_table(df, name).write.insertInto(name)


def touched(table: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """The rows of ``table`` in partitions that occur in ``batch``.

    The partitions of the batch are broadcast, and the scan is pruned by them when it runs: it reads no other, however far
    apart they lie. They are at most as many as partitions can be told by one scan. The smallest and largest value
    are literals of the filter besides, which spares even the listing of what lies outside.
    """
    low, high, unknown = batch.agg(
        F.min(partition), F.max(partition), F.count_if(F.col(partition).isNull())
    ).first()
    named = F.col(partition)
    if low is None:
        found = table.where(F.lit(False))
    else:
        wanted = batch.select(named.alias("_wanted")).where(F.col("_wanted").between(low, high)).distinct()
        found = table.where(named.between(low, high)).join(F.broadcast(wanted), named == F.col("_wanted"), "left_semi")
    return found.unionByName(table.where(named.isNull())) if unknown else found


def _insert(df: DataFrame, name: str, mode: str) -> None:
    with settings(df.sparkSession, {"spark.sql.sources.partitionOverwriteMode": mode}):
        _for_table(df, name).write.insertInto(name, overwrite=True)


def publish_partitions(df: DataFrame, name: str, partition: str | Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df``; all others stay.

    Rebalancing gathers the rows of a partition into few files and splits a
    partition too large for one task.
    """
    _insert(df.hint("rebalance", *_levels(partition)), name, "dynamic")


def publish_snapshot(df: DataFrame, name: str, partition: str | Sequence[str] | None = None) -> None:
    """Replace the whole content of a table; ``df`` must not read from it."""
    _insert(df.hint("rebalance", *_levels(partition)) if partition else df, name, "static")


#: Partitions that one statement names.
_DROPPED_AT_ONCE = 500


def drop_partitions(spark: SparkSession, name: str, partition: str | Sequence[str], values: Sequence) -> None:
    """Remove partitions with all their rows; of a table with several levels, ``values`` are tuples that name all of them."""
    levels = _levels(partition)

    def named(value) -> str:
        parts = [value] if isinstance(partition, str) else value
        told = ["NULL" if v is None else f"'{str(v).replace(chr(39), chr(92) + chr(39))}'" for v in parts]
        return f"PARTITION ({', '.join(f'`{p}` = {v}' for p, v in zip(levels, told, strict=True))})"

    for i in range(0, len(values), _DROPPED_AT_ONCE):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(named, values[i : i + _DROPPED_AT_ONCE]))}")


def overwrite_partitions_at(df: DataFrame, path: str, partition: str) -> None:
    """Path-based form of ``publish_partitions``."""
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def overwrite_snapshot_at(df: DataFrame, path: str) -> None:
    """Path-based form of ``publish_snapshot``; ``df`` must not read from ``path``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_at(df: DataFrame, path: str, partition: str) -> None:
    df.hint("rebalance", partition).write.mode("append").partitionBy(partition).parquet(path)


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each layer."""
    counts = [
        df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("row_count"))
        for name, df in layers.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
