"""Equi-joins in which NULL keys match each other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on ``keys``, kept once (from the left); ``how`` must not invent left rows."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def is_one_of(column: str, values: Sequence) -> Column:
    """Membership in a literal list that may contain None."""
    known = [v for v in values if v is not None]
    member = F.col(column).isin(known)
    return member if len(known) == len(values) else member | F.col(column).isNull()
