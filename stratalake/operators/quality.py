"""Quality gates: count violations in one pass, then decide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .merge import scd2_violations

class GateError(ValueError):
    """A batch or table failed its gate; nothing was published."""


# --- row conditions: true where a row violates --------------------------------


def outside_range(column: str, low: float, high: float) -> Column:
    """NULL is accepted, NaN is not."""
    return ~F.col(column).between(low, high)


def outside_domain(column: str, allowed: Sequence) -> Column:
    """Not one of the allowed values; NULL is not one of them."""
    return F.coalesce(~F.col(column).isin(list(allowed)), F.lit(True))


def not_recent(column: str, as_of: str, days: int = 30) -> Column:
    """Text that is no ``yyyy-MM-dd`` date, or a date more than ``days`` days before ``as_of``."""
    day = F.try_to_timestamp(F.col(column).cast("string"), F.lit("yyyy-M-d"))
    oldest = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return day.isNull() | (day < oldest)


def cast_failed(raw: Column, typed: Column) -> Column:
    """A value was present but did not convert."""
    return raw.isNotNull() & typed.isNull()


# --- reports ---------------------------------------------------------------------


def _as_rows(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("violations")) for n in names]
    return counts.select(F.inline(F.array(*pairs)))


def row_report(df: DataFrame, checks: Mapping[str, Column], non_empty: bool = True) -> DataFrame:
    """One row per check with its number of violating rows, from a single scan."""
    counts = [F.count_if(cond).alias(name) for name, cond in checks.items()]
    if non_empty:
        counts.append((F.count(F.lit(1)) == 0).cast("bigint").alias("not_empty"))
    return _as_rows(df.agg(*counts), [*checks, *(["not_empty"] if non_empty else [])])


def quality_report(
    df: DataFrame, keys: Sequence[str], checks: Mapping[str, Column] | None = None
) -> DataFrame:
    """Batch report: not empty, keys present, keys unique, and the given row checks.

    One scan: violations are counted per key together with the key's rows
    (combined on the map side), then added up.
    """
    rows = {f"{k}_present": F.col(k).isNull() for k in keys} | dict(checks or {})
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(cond).alias(name) for name, cond in rows.items()]
    )
    totals = per_key.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in rows],
        (F.count(F.lit(1)) == 0).cast("bigint").alias("not_empty"),
        F.count_if(F.col("_rows") > 1).alias("unique_keys"),
    )
    return _as_rows(totals, [*rows, "not_empty", "unique_keys"])


def history_report(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with several or with no current row, from one aggregation."""
    current = F.col("current_rows")
    return row_report(
        scd2_violations(table, keys),
        {"multiple_current": current > 1, "missing_current": current == 0},
        non_empty=False,
    )


def interval_report(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Versions that end before they start, that overlap the next version of their key, or whose flag doesn't
    fit their end. A key has as many versions as runs that changed it."""
    along = Window.partitionBy(*keys).orderBy("effective_from", F.col("effective_to").asc_nulls_last())
    start, end = F.col("effective_from"), F.col("effective_to")
    checks = {
        "backward_interval": end < start,
        "overlapping_versions": F.coalesce(end, F.lit("9999-12-31").cast("timestamp")) > F.col("_next"),
        "flag_and_end": F.col("is_current").isNull() | (F.col("is_current") != end.isNull()),
    }
    return row_report(table.withColumn("_next", F.lead("effective_from").over(along)), checks, non_empty=False)


def range_checks(df: DataFrame, suffix: str = "_score", low: float = 0, high: float = 100) -> dict[str, Column]:
    """A range check for every column with the suffix."""
    return {c: outside_range(c, low, high) for c in df.columns if c.endswith(suffix)}


def missing_columns(df: DataFrame, required: Sequence[str], members: str | None = None) -> tuple[int, list[str]]:
    """Row count, and the required columns that no row has.

    Presence goes by names: those in the list column ``members`` where a row has one, else the columns of
    ``df``. A column that is there but NULL throughout is present.
    """
    if members is None:
        return df.count(), [c for c in required if c not in df.columns]
    found = [
        F.count_if(F.col(members).isNull() | F.array_contains(members, c)).alias(c) for c in required
    ]
    seen = df.agg(F.count(F.lit(1)).alias("_rows"), *found).first()
    return seen["_rows"], [c for c in required if seen["_rows"] and seen[c] == 0]


def enforce(report: DataFrame, what: str) -> None:
    """Raise if any check of the report (a handful of rows) was violated."""
    failed = {r["check"]: r["violations"] for r in report.where("violations > 0").collect()}
    if failed:
        raise GateError(f"{what}: {failed}")
