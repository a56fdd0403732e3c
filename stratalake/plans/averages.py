"""Calendar averages kept up to date: a table of partial sums that each run changes by what came and what went."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import GateError
from ..operators.rolling import PARTIAL, RollingSpec, averages_of, merge_month_sums, month_sums
from ..session import Scratch
from ..sources import tables


def refresh_averages(
    spark: SparkSession, name: str, spec: RollingSpec, as_of: str, came: DataFrame, gone: DataFrame | None = None,
    provider: str = "parquet", location: str | None = None,
) -> None:
    """Add the rows that ``came`` to the sums of their months and take off those that are ``gone``; a changed row is both.

    Only the years of these rows are read and replaced; nothing else of the fact is looked at, however old the rows
    are. Runs come in the order of ``as_of``; the last one may be repeated with the same rows, an earlier one is refused. Sums of whole numbers and
    decimals are exact; those of doubles carry the rounding of every difference.
    """
    difference = month_sums(came, spec)
    if gone is not None:
        difference = difference.unionByName(month_sums(gone, spec, -1))
    kinds = dict(difference.dtypes)
    columns = {spec.entity: kinds[spec.entity], "month": "int"}
    columns |= {f"{c}{state}": kinds[c] for state in ("", "_before") for c in PARTIAL}
    tables.create_table(spark, name, columns | {"run_at": "timestamp", "year": "int"}, "year", provider, location)
    with Scratch(spark, "averages") as scratch:
        difference = scratch.save(difference)
        held = tables.touched(spark.table(name), difference, "year")
        if not held.where(F.col("run_at") > F.lit(as_of).cast("timestamp")).limit(1).isEmpty():
            raise GateError(f"{name}: the run's time {as_of} is before that of stored sums")
        tables.publish_partitions(scratch.save(merge_month_sums(held, difference, spec, as_of)), name, "year")


def stored_averages(spark: SparkSession, name: str, spec: RollingSpec) -> DataFrame:
    """Monthly and yearly averages from the stored sums."""
    return averages_of(spark.table(name), spec)
