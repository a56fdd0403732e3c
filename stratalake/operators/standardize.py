"""Bronze rows to typed silver rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casting import cast_or_null, year_month
from ..functions.hashing import record_hash

SCD2_COLUMNS = ("record_hash", "effective_from", "effective_to", "is_current")
LINEAGE_COLUMNS = ("dag_id", "run_id", "processed_at")


def standardize(
    df: DataFrame,
    types: Mapping[str, str],
    renames: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rename, then select exactly the typed columns, in order, in one projection, and behind them those in ``keep``.

    Columns the batch lacks come out as typed NULLs; the required-column gate
    decides whether that is acceptable.
    """
    for old, new in (renames or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    have = {f.name: f.dataType for f in df.schema.fields}

    def typed(name: str, dtype: str) -> Column:
        if name not in have:
            return F.lit(None).cast(dtype)
        return cast_or_null(name, dtype, text=isinstance(have[name], T.StringType))

    return df.select(*[typed(name, dtype).alias(name) for name, dtype in types.items()], *keep)


def with_month_partition(df: DataFrame, time_column: str, name: str = "year_month") -> DataFrame:
    return df.withColumn(name, year_month(time_column))


def with_lineage(df: DataFrame, dag_id: str, run_id: str, as_of: str) -> DataFrame:
    """Stamp every row with its run; ``as_of`` is a literal, so re-evaluation cannot change it."""
    return df.withColumns(
        {
            "dag_id": F.lit(dag_id),
            "run_id": F.lit(run_id),
            "processed_at": F.lit(as_of).cast("timestamp"),
        }
    )


def with_history_columns(df: DataFrame, hash_columns: Sequence[str], as_of: str) -> DataFrame:
    """Add the fingerprint and the open validity interval of a new version."""
    return df.withColumns(
        {
            "record_hash": record_hash(hash_columns),
            "effective_from": F.lit(as_of).cast("timestamp"),
            "effective_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )
