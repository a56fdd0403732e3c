"""JSON Lines of the raw zone: scans and the partitioned sink."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casting import cast_or_null
from ..session import settings

CORRUPT = "_corrupt_record"
MEMBERS = "_members"
ZONE_PARTITIONS = ("source", "dataset", "ingestion_date")
#: The folder below those of the zone that one ingestion has for itself.
RUN = "ingest_run"
#: While a zone is written: rows that repeat their names are JSON of some twenty times their shuffled size, so tasks get few bytes, and
#: a task keeps so many folders open. It streams its rows into them and sorts only those of more folders.
_WRITING = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m", "spark.sql.maxConcurrentOutputFileWriters": "32"}


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def scan_bronze(
    spark: SparkSession,
    keys: Sequence[str],
    columns: Sequence[str],
    mode: str = "FAILFAST",
    base_path: str | None = None,
    members: bool = False,
) -> DataFrame:
    """Read exactly the given objects.

    All values arrive as text and are typed afterwards, so one odd number
    cannot change a column's type. A line holds an object, or a list of objects, which are
    a row each. FAILFAST aborts on a malformed line; PERMISSIVE keeps it whole in
    ``_corrupt_record``. With ``base_path`` the ``name=value`` folders above an object become
    columns. With ``members`` the member names of each line's object are kept in ``_members``
    (NULL for a list).
    """
    if not keys:
        raise ValueError("no object keys given")
    if mode not in ("FAILFAST", "PERMISSIVE"):
        raise ValueError("mode must be FAILFAST or PERMISSIVE")
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    lines = reader.text(list(keys)).where("trim(value) <> ''")
    folders = [c for c in lines.columns if c != "value"]
    inside = [c for c in columns if c not in folders]
    parsed = F.from_json("value", T.ArrayType(_text_schema(inside)), {"mode": mode})
    bound = lines.select("value", *folders, F.explode(F.array(parsed)).alias("_rows"))
    # a line that can't be parsed stays as one row; an empty list is none
    rows = bound.where("_rows IS NULL OR size(_rows) > 0").select("*", F.explode_outer("_rows").alias("_row"))
    out = [F.col("_row")[c].alias(c) for c in inside]
    if mode == "PERMISSIVE":
        out.append(F.when(F.col("_row").isNull(), F.col("value")).alias(CORRUPT))
    if members:
        out.append(F.json_object_keys("value").alias(MEMBERS))
    return rows.select(*out, *folders)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined lines) of a permissive scan."""
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.where(F.col(CORRUPT).isNotNull())


def scan_raw_zone(spark: SparkSession, base: str, types: Mapping[str, str]) -> DataFrame:
    """Read a zone laid out as ``source=/dataset=/ingestion_date=``.

    Partitions are discovered from the folders and prune on filters. Member
    names match in any case; a malformed line gives a row of NULLs.
    """
    # the columns stay text whatever the folder names look like; of members that differ in case alone the
    # first counts
    entries = F.map_entries(F.from_json("value", "map<string,string>"))
    lowered = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(lowered, lambda e: e["key"])
    lines = (
        spark.read.schema("value STRING, source STRING, dataset STRING, ingestion_date DATE")
        .text(base)
        .withColumn("_lowered", lowered)
        .withColumn("_names", names)
    )

    def member(name: str) -> Column:
        place = F.array_position("_names", name.lower()).cast("int")
        return F.when(place > 0, F.get("_lowered", place - 1)["value"])

    return lines.select(
        *[cast_or_null(member(name), dtype).alias(name) for name, dtype in types.items()],
        *ZONE_PARTITIONS,
    )


def stamp(df: DataFrame, ingested_at: str) -> DataFrame:
    """One ingestion time for the whole batch, and its date for the folder."""
    return df.withColumn("ingested_at", F.lit(ingested_at)).withColumn(
        "ingestion_date", F.lit(ingested_at[:10]).cast("date")
    )


def run_name(dataset: str, ingested_at: str) -> str:
    """What the folder of one ingestion is called: the same for every try of it."""
    return re.sub(r"[^A-Za-z0-9_.-]", "-", f"{dataset}_{ingested_at}")


def _append(df: DataFrame, base: str, partitions: Sequence[str], run: str | None, max_records_per_file: int) -> None:
    """JSON Lines below one folder per value; with ``run`` in folders of that run."""
    if run is not None:
        df, partitions = df.withColumn(RUN, F.lit(run)), [*ZONE_PARTITIONS, RUN, *[p for p in partitions if p not in ZONE_PARTITIONS]]
    with settings(df.sparkSession, _WRITING):
        (
            df.hint("rebalance", *partitions)
            .write.mode("append")
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(*partitions)
            .json(base)
        )


def write_raw_zone(df: DataFrame, base: str, ingested_at: str, max_records_per_file: int = 5_000_000, run: str | None = None) -> None:
    """Append JSON Lines below ``base/source=/dataset=/ingestion_date=``, with ``run`` one folder deeper.

    Rebalancing gathers the rows of a folder into few files and splits a folder too
    large for one task.
    """
    _append(stamp(df, ingested_at), base, ZONE_PARTITIONS, run, max_records_per_file)


def entity_counts(df: DataFrame, entity: Column) -> DataFrame:
    """Records per entity, the manifest of a fan-out write."""
    return df.groupBy(entity.alias("entity")).agg(F.count(F.lit(1)).alias("record_count"))


def write_per_entity(
    df: DataFrame, base: str, entity: Column, ingested_at: str, max_records_per_file: int = 5_000_000, run: str | None = None
) -> DataFrame:
    """Write one folder of files per entity and return the counts; a row without entity is an error.

    Rows are shuffled by entity and rebalanced by Spark, which splits an
    entity too large for one task.
    """
    named = stamp(df.withColumn("entity", entity), ingested_at)
    without = named.where(F.col("entity").isNull() | (F.col("entity") == ""))
    if not without.isEmpty():
        raise ValueError("a record has no entity")
    _append(named, base, [*ZONE_PARTITIONS, "entity"], run, max_records_per_file)
    return entity_counts(named, F.col("entity"))


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def run_folders(spark: SparkSession, base: str, source: str, ingested_at: str, run: str, entities: bool = False) -> list[str]:
    """The folders that one ingestion wrote, found by listing names alone; with ``entities`` one for each entity."""
    files, pattern = _path(spark, f"{base}/source={source}/dataset=*/ingestion_date={ingested_at[:10]}/{RUN}={run}{'/entity=*' if entities else ''}")
    return sorted(str(f.getPath()) for f in files.globStatus(pattern) or [])


def remove_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        files, path = _path(spark, folder)
        files.delete(path, True)


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all: written beside its place, then renamed."""
    files, place = _path(spark, path)
    _, beside = _path(spark, f"{path}.writing")
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(beside, place) and not files.exists(place):
        raise OSError(f"can't publish {path}")


def published_text(spark: SparkSession, path: str) -> str | None:
    files, place = _path(spark, path)
    return spark.read.text(path, wholetext=True).first()[0] if files.exists(place) else None
