"""Run manifests: gate them, compare them with the data, list what runs did."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Members of a success manifest.
SUCCESS = "SUCCESS"
MANIFEST = (
    "status STRING, lambda_exec_ts STRING, domain STRING, source STRING, dataset STRING, "
    "keys ARRAY<STRING>, record_count BIGINT, ingested_at STRING"
)
REQUIRED = ("domain", "source", "dataset", "keys", "ingested_at", "lambda_exec_ts")


def manifest_gate(df: DataFrame, column: str = "manifest") -> DataFrame:
    """Parse manifests and add ``problem``, NULL for those a job may start from."""
    m = F.col("_m")
    absent = F.lit(False)
    for name in REQUIRED:
        absent = absent | m[name].isNull()
    problem = (
        F.when(F.try_parse_json(column).isNull(), "not json")
        .when(~m["status"].eqNullSafe(SUCCESS), "not successful")
        .when(F.coalesce(m["record_count"], F.lit(0)) == 0, "no records")
        .when(absent, "missing field")
    )
    return (
        df.withColumn("_m", F.from_json(column, MANIFEST))
        .withColumn("problem", problem)
        .select(*[c for c in df.columns if c != column], "_m.*", "problem")
    )


def manifest_reconcile(manifests: DataFrame, rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Announced against counted records per group; ``difference`` is 0 where they agree."""
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    announced = manifests.select(*by, F.col("record_count").alias("announced"), none.alias("counted"))
    counted = rows.select(*by, none.alias("announced"), one.alias("counted"))
    return (
        announced.unionByName(counted)
        .groupBy(*by)
        .agg(F.sum("announced").alias("announced"), F.sum("counted").alias("counted"))
        .withColumn("difference", F.col("counted") - F.col("announced"))
    )


def run_history(versions: DataFrame) -> DataFrame:
    """One row per run that changed a versioned table: versions it opened and closed."""
    changes = versions.select(
        F.inline(
            F.array(
                F.struct(F.col("effective_from").alias("run_at"), F.lit(1).alias("o"), F.lit(0).alias("c")),
                F.struct(F.col("effective_to").alias("run_at"), F.lit(0).alias("o"), F.lit(1).alias("c")),
            )
        )
    ).where("run_at IS NOT NULL")
    return changes.groupBy("run_at").agg(
        F.sum("o").alias("opened"),
        F.sum("c").alias("closed"),
        (F.sum("o") - F.sum("c")).alias("net_current"),
    )
