"""Rolling market metrics over the rows of one entity in time order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import save_and_read, scratch_path
from .joins import null_safe_join


@dataclass(frozen=True)
class RollingSpec:
    """What to compute, in rows: moving means and the volatility of returns."""

    entity: str = "symbol"
    order: str = "trade_date"
    value: str = "close"
    means: tuple[int, ...] = (5, 20)
    volatility: int = 20
    ties: tuple[str, ...] = field(default=())

    @property
    def lookback(self) -> int:
        """Rows before a row that its metrics depend on; a return needs one more close."""
        return max([n - 1 for n in self.means] + [self.volatility])

    @property
    def sort(self) -> list[str]:
        return [self.order, *self.ties]


def add_rolling(df: DataFrame, spec: RollingSpec, groups: Sequence[str] | None = None) -> DataFrame:
    """Add ``daily_return``, ``ma_<n>_<value>`` and ``volatility_<n>``.

    A zero or missing previous value gives a NULL return. Frames at the start
    of a series hold the rows there are. Everything shares one shuffle by
    entity. A date-ordered frame with one row per entity and date has at most
    one row per calendar day in a group; for finer series use ``rolling_in_pieces``.
    """
    series = Window.partitionBy(*(groups or [spec.entity])).orderBy(*spec.sort)
    previous = F.lag(spec.value).over(series)
    out = df.withColumn("daily_return", F.try_divide(F.col(spec.value) - previous, previous))
    for n in spec.means:
        out = out.withColumn(
            f"ma_{n}_{spec.value}", F.avg(spec.value).over(series.rowsBetween(1 - n, 0))
        )
    n = spec.volatility
    return out.withColumn(
        f"volatility_{n}", F.stddev_samp("daily_return").over(series.rowsBetween(1 - n, 0))
    )


def rolling_in_pieces(df: DataFrame, spec: RollingSpec) -> DataFrame:
    """``add_rolling`` for series of any length and skew: no task holds more than a piece.

    Rows are range-partitioned by entity and time (``spec.sort`` must tell the rows of
    an entity apart) and stored with the number of their piece. A series that crosses
    into a later piece hands it the ``lookback`` rows before the border. Only the last
    entity of a piece can do so, so what is handed on is a few rows for each piece,
    passed on where pieces are shorter than that. Rows without an entity are a series of
    their own.
    """
    spark, columns = df.sparkSession, df.columns
    order = [F.col(spec.entity), *[F.col(c) for c in spec.sort]]
    dealt = df.repartitionByRange(*order).withColumn("_piece", F.spark_partition_id())
    pieces = save_and_read(dealt, scratch_path(spark, "pieces"))

    # the entity with which each piece ends; NULL sorts first, so it is last only if it is alone
    last = pieces.groupBy("_piece").agg(F.max(spec.entity).alias(spec.entity))
    last = last.withColumn("_next", F.lead("_piece").over(Window.orderBy("_piece")))  # one row per piece
    from_end = Window.partitionBy("_piece").orderBy(*[F.col(c).desc() for c in spec.sort])
    ends = null_safe_join(pieces, last, [spec.entity, "_piece"], "inner")
    ends = ends.withColumn("_back", F.row_number().over(from_end)).where(F.col("_back") <= spec.lookback)

    # a few rows per piece are left: the rows before each border, in time order over all pieces
    along = Window.partitionBy(spec.entity).orderBy(*spec.sort)
    before = ends.withColumn(
        "_rows", F.collect_list(F.struct(*columns)).over(along.rowsBetween(1 - spec.lookback, 0))
    ).where("_back = 1 AND _next IS NOT NULL")
    lead_in = before.select(F.inline("_rows"), F.col("_next").alias("_piece"))
    both = pieces.withColumn("_own", F.lit(True)).unionByName(lead_in.withColumn("_own", F.lit(False)))
    return add_rolling(both, spec, ["_piece", spec.entity]).where("_own").drop("_own", "_piece")


def calendar_averages(df: DataFrame, spec: RollingSpec) -> DataFrame:
    """Monthly and yearly average of the value, repeated on each row.

    The averages come from one map-side combined aggregate by month (a year is made of
    its months), joined back: no entity is gathered in one task.
    """
    dated = df.withColumns({"_year": F.year(spec.order), "_month": F.month(spec.order)})
    by_month = dated.groupBy(spec.entity, "_year", "_month").agg(
        F.sum(spec.value).alias("_sum"), F.count(spec.value).alias("_n")
    )
    months = Window.partitionBy(spec.entity, "_year")  # at most twelve rows
    averages = by_month.select(
        spec.entity,
        "_year",
        "_month",
        F.try_divide(F.sum("_sum").over(months), F.sum("_n").over(months)).alias(f"yearly_avg_{spec.value}"),
        F.try_divide("_sum", "_n").alias(f"monthly_avg_{spec.value}"),
    )
    return null_safe_join(dated, averages, [spec.entity, "_year", "_month"], "left").drop("_year", "_month")


#: What a calendar average is made of: rows, those with a value, and the sum of the values.
PARTIAL = ("n_rows", "n_values", "total")


def month_sums(df: DataFrame, spec: RollingSpec, sign: int = 1) -> DataFrame:
    """``PARTIAL`` by entity, ``year`` and ``month``; negative with ``sign=-1``, for rows that went."""
    found = df.groupBy(spec.entity, F.year(spec.order).alias("year"), F.month(spec.order).alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(spec.value).alias("n_values"),
        F.coalesce(F.sum(spec.value), F.lit(0)).alias("total"),
    )
    return found.select(spec.entity, "year", "month", *[(F.col(c) * sign).cast(found.schema[c].dataType).alias(c) for c in PARTIAL])


def merge_month_sums(held: DataFrame, difference: DataFrame, spec: RollingSpec, as_of: str) -> DataFrame:
    """The stored partial sums after a run that changes them by ``difference``.

    Every row keeps the time of the run that wrote it (``run_at``) and its sums before that run, so the same run
    a second time, after a failure at any point too, starts from those and adds nothing twice. Rows that the run doesn't name stay.
    """
    keys, at = [spec.entity, "year", "month"], F.lit(as_of).cast("timestamp")
    states = [*PARTIAL, *[f"{c}_before" for c in PARTIAL]]
    stored = held.select(*keys, *states, "run_at", F.lit(False).alias("named"), *[F.lit(0).alias(f"d_{c}") for c in PARTIAL])
    told = difference.select(*keys, F.lit(True).alias("named"), *[F.col(c).alias(f"d_{c}") for c in PARTIAL])
    # a month has one stored row at most
    both = stored.unionByName(told, allowMissingColumns=True).groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in [*states, "run_at", "named"]], *[F.sum(f"d_{c}").alias(f"d_{c}") for c in PARTIAL]
    )
    again = F.coalesce(F.col("run_at") == at, F.lit(False))
    changed = F.col("named") | again
    out = {"run_at": F.when(changed, at).otherwise(F.col("run_at"))}
    for c in PARTIAL:
        base = F.coalesce(F.when(again, F.col(f"{c}_before")).otherwise(F.col(c)), F.lit(0))
        out[c] = F.when(changed, base + F.col(f"d_{c}")).otherwise(F.col(c))
        out[f"{c}_before"] = F.when(changed, base).otherwise(F.col(f"{c}_before"))
    return both.select(*[out.get(c, F.col(c)).cast(held.schema[c].dataType).alias(c) for c in held.columns])


def averages_of(sums: DataFrame, spec: RollingSpec) -> DataFrame:
    """Monthly and yearly average by entity, ``year`` and ``month``, of months that have rows."""
    year = Window.partitionBy(spec.entity, "year")  # at most twelve rows
    return sums.where("n_rows > 0").select(
        spec.entity,
        "year",
        "month",
        "n_rows",
        F.try_divide("total", "n_values").alias(f"monthly_avg_{spec.value}"),
        F.try_divide(F.sum("total").over(year), F.sum("n_values").over(year)).alias(f"yearly_avg_{spec.value}"),
    )


def _last_rows(df: DataFrame, spec: RollingSpec, rows: int | None = None) -> DataFrame:
    back = Window.partitionBy(spec.entity).orderBy(*[F.col(c).desc() for c in spec.sort])
    return (
        df.withColumn("_back", F.row_number().over(back))
        .where(F.col("_back") <= (rows or spec.lookback))
        .drop("_back")
    )


def refresh_rolling(fact: DataFrame, since, spec: RollingSpec) -> DataFrame:
    """Metrics of all rows dated ``since`` or later, equal to a full recompute.

    ``since`` is a literal, so partitions prune. The rows needed before it are counted in
    rows, not days, and only entities that have later rows are looked up; the map side keeps
    the last rows of each.
    """
    order = F.col(spec.order)
    start = F.lit(since).cast("date")
    affected = fact.where(order >= start)
    older = null_safe_join(fact.where(order < start), affected.select(spec.entity).distinct(), [spec.entity], "left_semi")
    return add_rolling(_last_rows(older, spec).unionByName(affected), spec).where(order >= start)


def refresh_changed(
    fact: DataFrame, changed: DataFrame, spec: RollingSpec, tails: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(metrics to replace, new tails) after rows named by (entity, order) in ``changed`` came, went or changed.

    Of each changed entity, the rows from its first changed one to ``lookback`` rows after its
    last changed one get new metrics; other entities and later rows keep theirs. ``tails`` has the last
    ``2 * lookback`` rows of every entity before the change (all of them, if there are fewer). Where
    they reach far enough back before the first change they are the only history that is read; only
    entities with an earlier change are looked up in the older rows of ``fact``. An entity that
    ``tails`` doesn't name is new.
    """
    key, order, keep = spec.entity, F.col(spec.order), 2 * spec.lookback
    spans = changed.groupBy(key).agg(F.min(spec.order).alias("_first"), F.max(spec.order).alias("_last"))
    since = changed.agg(F.min(spec.order)).first()[0]
    if since is None:
        raise ValueError("no changed rows")
    columns = fact.columns
    recent = null_safe_join(fact.where(order >= F.lit(since)), spans, [key], "inner").where(order >= F.col("_first"))
    recent = recent.select(*columns, "_last")

    late, context = spans.select(key, "_first"), []
    if tails is not None:
        held = null_safe_join(tails.select(*columns), spans, [key], "inner")
        reach = held.groupBy(key).agg(
            F.first("_first").alias("_first"), F.count(F.lit(1)).alias("_all"), F.count_if(order < F.col("_first")).alias("_before")
        )
        late = reach.where((F.col("_all") >= keep) & (F.col("_before") < spec.lookback)).select(key, "_first")
        known = null_safe_join(held.where(order < F.col("_first")).select(*columns), late, [key], "left_anti")
        context.append(known)
    if tails is None or not late.isEmpty():
        older = null_safe_join(fact, late, [key], "inner").where(order < F.col("_first"))
        context.append(_last_rows(older.select(*columns), spec, keep))
    before = context[0] if len(context) == 1 else context[0].unionByName(context[1])

    # the rows after the last changed one that still look back on it
    along = Window.partitionBy(key).orderBy(*spec.sort)
    before = before.withColumn("_last", F.lit(None).cast(fact.schema[spec.order].dataType)).withColumn("_own", F.lit(False))
    both = before.unionByName(recent.withColumn("_own", F.lit(True)))
    past = F.count_if(F.col("_own") & (order > F.col("_last"))).over(along)
    metrics = add_rolling(both.withColumn("_past", past), spec).where(F.col("_own") & (F.col("_past") <= spec.lookback))
    return metrics.drop("_own", "_last", "_past"), _last_rows(both.select(*columns), spec, keep)
