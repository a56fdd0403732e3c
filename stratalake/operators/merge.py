"""Merges as joins, for tables whose storage has no row-level MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import null_safe_join


def _full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of whole rows as structs ``t`` and ``s``; NULL keys match each other.

    Both sides hold one row per key, so no key can be hot here.
    """
    t = left.select(F.struct(*left.columns).alias("t"), *[F.col(k).alias(f"_t_{k}") for k in keys])
    s = right.select(F.struct(*right.columns).alias("s"), *[F.col(k).alias(f"_s_{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & t[f"_t_{k}"].eqNullSafe(s[f"_s_{k}"])
    return t.join(s, on, "full_outer")


def scd2_merge(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    require_newer: bool = False,
    recency: str = "ingested_at",
) -> DataFrame:
    """Merge one batch (one row per key) into a versioned table and return the new table.

    A key whose fingerprint changed closes its current row at the new row's
    ``effective_from`` and opens the new row in the same pass. Unchanged keys
    and closed rows stay as they are, so replaying a batch changes nothing.
    With ``require_newer`` a batch row not newer than the current row is ignored.
    Closed rows bypass the join, hence they are never shuffled; a row whose flag is
    NULL counts as closed.
    """
    closed = target.where(~F.coalesce("is_current", F.lit(False)))
    return closed.unionByName(scd2_step(target.where("is_current"), incoming, keys, require_newer, recency))


def scd2_step(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    require_newer: bool = False,
    recency: str = "ingested_at",
) -> DataFrame:
    """What a merge makes of the current rows: those that stay or open, and the versions that it closes.

    Versions closed before are no part of it, so its work doesn't grow with the history.
    """
    columns = current.columns
    pairs = _full_join(current, incoming.select(*columns), keys)

    t, s = F.col("t"), F.col("s")
    keep = t["record_hash"].eqNullSafe(s["record_hash"])
    if require_newer:
        keep = keep | F.coalesce(s[recency] <= t[recency], F.lit(False))
    ended = F.struct(
        *[
            (
                s["effective_from"]
                if c == "effective_to"
                else F.lit(False)
                if c == "is_current"
                else t[c]
            ).alias(c)
            for c in columns
        ]
    )
    rows = (
        F.when(s.isNull(), F.array(t))
        .when(t.isNull(), F.array(s))
        .when(keep, F.array(t))
        .otherwise(F.array(ended, s))
    )
    return pairs.select(F.inline(rows))


def scd2_as_of(table: DataFrame, moment: str) -> DataFrame:
    """The table as it stood at ``moment``: later versions gone, rows closed later open again."""
    at = F.lit(moment).cast("timestamp")
    open_then = F.col("effective_to").isNull() | (F.col("effective_to") > at)
    return (
        table.where(F.col("effective_from") <= at)
        .withColumn("is_current", open_then)
        .withColumn("effective_to", F.when(open_then, F.lit(None)).otherwise(F.col("effective_to")))
    )


def scd2_current(table: DataFrame) -> DataFrame:
    return table.where("is_current")


def scd2_history(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every version of the keys that changed at least once, found by their closed rows."""
    changed = table.where(~F.coalesce("is_current", F.lit(False))).select(*keys).distinct()
    return null_safe_join(table, changed, keys, "left_semi")


def scd2_reopen(table: DataFrame, condition: Column, effective_from: str) -> DataFrame:
    """Point repair: closed rows that satisfy ``condition`` become current from a given time."""
    hit = condition & ~F.coalesce("is_current", F.lit(False))
    return table.withColumns(
        {
            "effective_from": F.when(hit, F.lit(effective_from).cast("timestamp")).otherwise(
                F.col("effective_from")
            ),
            "effective_to": F.when(hit, F.lit(None)).otherwise(F.col("effective_to")),
            "is_current": F.coalesce(hit, F.lit(False)) | F.col("is_current"),
        }
    )


def scd2_violations(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys without exactly one current row, with ``current_rows`` (0, or 2 and more)."""
    return (
        table.groupBy(*keys)
        .agg(F.count_if(F.col("is_current")).alias("current_rows"))
        .where("current_rows <> 1")
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    stamp: str | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Type-1 merge: update the listed columns of known keys, insert unknown keys.

    Columns outside ``update`` keep the value of their first insert. ``stamp``
    names a timestamp column set to ``as_of`` on every row the source touched.
    """
    pairs = _full_join(target, source, keys)
    t, s = F.col("t"), F.col("s")
    known = set(source.columns)

    def value(c: str) -> Column:
        if c == stamp:
            return F.when(s.isNotNull(), F.lit(as_of).cast("timestamp")).otherwise(t[c])
        if c not in known:
            return t[c]
        if c in update:
            return F.when(s.isNotNull(), s[c]).otherwise(t[c])
        return F.when(t.isNotNull(), t[c]).otherwise(s[c])

    return pairs.select(*[value(c).alias(c) for c in target.columns])
