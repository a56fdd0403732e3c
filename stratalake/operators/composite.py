"""Normalised indicators, channel scores and the weighted index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import null_safe_join

NEUTRAL = 50.0


def minmax_norm(
    df: DataFrame,
    groups: Sequence[str] = ("indicator", "year"),
    value: str = "value",
    directions: Mapping[str, int] | None = None,
) -> DataFrame:
    """Add ``min_v``, ``max_v`` and ``norm``: the value scaled to 0..100 within its group.

    A group whose values are all equal is neutral (50), also for a NULL
    value; a group without values stays NULL. ``directions`` maps indicators
    where more is worse to -1; the default keeps every indicator as it is.
    Group extremes come from a map-side combined aggregate joined back, so no group is
    gathered in one task; adaptive execution broadcasts them where they are small when the
    join runs, and splits a group too large for one task.
    """
    stats = df.groupBy(*groups).agg(F.min(value).alias("min_v"), F.max(value).alias("max_v"))
    rows = null_safe_join(df, stats, groups, "left")
    span = F.col("max_v") - F.col("min_v")
    norm = F.when(F.col("max_v") == F.col("min_v"), F.lit(NEUTRAL)).otherwise(
        F.try_divide(F.col(value) - F.col("min_v"), span) * 100
    )
    reversed_ones = [name for name, sign in (directions or {}).items() if sign < 0]
    if reversed_ones:
        norm = F.when(F.col("indicator").isin(reversed_ones), 100 - norm).otherwise(norm)
    return rows.withColumn("norm", norm)


def pivot_norms(
    normalised: DataFrame, indicators: Sequence[str], entity: Sequence[str] = ("country", "year")
) -> DataFrame:
    """One row per entity with a ``<indicator>_norm`` column each.

    Equal to full outer joins of one frame per indicator, in a single
    aggregation. Entities that have none of the indicators are left out.
    """
    return (
        normalised.where(F.col("indicator").isin(list(indicators)))
        .groupBy(*entity)
        .agg(
            *[
                F.max(F.when(F.col("indicator") == i, F.col("norm"))).alias(f"{i}_norm")
                for i in indicators
            ]
        )
    )


def coverage_ratio(indicators: Sequence[str]) -> Column:
    """Share of the indicators that have a value."""
    known = [F.col(f"{i}_norm").isNotNull().cast("int") for i in indicators]
    return sum(known[1:], known[0]) / F.lit(float(len(indicators)))


def weighted_channels(
    wide: DataFrame,
    channels: Mapping[str, Mapping[str, float]],
    missing: float | None = None,
) -> DataFrame:
    """Add one column per channel: the weighted sum of its normalised indicators.

    With ``missing`` an absent indicator counts as that value, otherwise it
    makes the channel NULL. A channel without indicators is neutral.
    """

    def channel(weights: Mapping[str, float]) -> Column:
        if not weights:
            return F.lit(NEUTRAL)
        parts = []
        for indicator, weight in weights.items():
            norm = F.col(f"{indicator}_norm")
            if missing is not None:
                norm = F.coalesce(norm, F.lit(missing))
            parts.append(F.lit(weight) * norm)
        return sum(parts[1:], parts[0])

    return wide.withColumns({name: channel(weights) for name, weights in channels.items()})


def composite(weights: Mapping[str, float]) -> Column:
    """The weighted sum of score columns."""
    parts = [F.lit(w) * F.col(c) for c, w in weights.items()]
    return sum(parts[1:], parts[0])
