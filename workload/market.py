"""Typed rows, fingerprints, deduplication and rolling metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.hashing import record_hash
from stratalake.operators.dedup import append_then_dedup, duplicate_keys
from stratalake.operators.reports import most_recent
from stratalake.operators.rolling import (
    RollingSpec,
    add_rolling,
    calendar_averages,
    refresh_changed,
    refresh_rolling,
    rolling_in_pieces,
)
from stratalake.operators.standardize import standardize, with_lineage, with_month_partition
from stratalake.plans.averages import refresh_averages, stored_averages
from stratalake.session import save_and_read, scratch_path
from stratalake.sources.tables import append_at, overwrite_partitions_at, touched

from .derived import (
    BARS,
    LATEST_LINES,
    LINE_KEYS,
    LINE_TIES,
    PRICES,
    bars,
    latest_lines,
    prices,
)
from .registry import moment, query, rounded, table, text, whole

AS_OF = "2024-02-01 00:00:00"


# --- standardise ---------------------------------------------------------------------


@query(
    "standardize",
    f"""SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, strftime(l_shipdate, '%Y-%m-%d') AS trade_date,
         l_extendedprice AS open, l_quantity AS high, TRY_CAST(l_returnflag AS DOUBLE) AS low,
         l_discount AS close, CAST(l_quantity AS BIGINT) AS volume,
         CAST(l_orderkey AS BIGINT) AS batch_key, 'run-1' AS run_id, '{AS_OF}' AS processed_at
  FROM lineitem""",
)
def standardize_lines(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_extendedprice").cast("string").alias("open"),
        F.col("l_quantity").cast("string").alias("high"),
        F.col("l_returnflag").alias("low"),
        F.col("l_discount").cast("string").alias("close"),
        F.col("l_quantity").cast("string").alias("volume"),
        F.col("l_orderkey").cast("string").alias("batch_key"),
    )
    types = {
        "symbol": "string",
        "trade_date": "date",
        "open": "double",
        "high": "double",
        "low": "double",
        "close": "double",
        "volume": "bigint",
        "batch_key": "bigint",
    }
    typed = with_lineage(standardize(raw, types, {"date": "trade_date"}), "dag", "run-1", AS_OF)
    return typed.select(
        "symbol", text("trade_date"), "open", "high", "low", "close", "volume", "batch_key",
        "run_id", moment("processed_at"),
    )


@query(
    "record_hash",
    """SELECT o_orderkey AS orderkey,
         sha256(concat_ws('||', CAST(o_custkey AS VARCHAR), o_orderpriority,
                          coalesce(nullif(o_orderstatus, 'P'), '<null>'), CAST(o_orderkey AS VARCHAR))) AS record_hash
  FROM orders""",
)
def hash_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn(
        "o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P"))
    )
    columns = ["o_custkey", "o_orderpriority", "o_orderstatus", "o_orderkey"]
    return orders.select(F.col("o_orderkey").alias("orderkey"), record_hash(columns).alias("record_hash"))


@query(
    "month_partition",
    "SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS orders FROM orders GROUP BY 1",
)
def month_partition(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderdate")
    return with_month_partition(orders, "o_orderdate").groupBy("year_month").agg(
        F.count(F.lit(1)).alias("orders")
    )


# --- duplicates --------------------------------------------------------------------------

_LINE_OUT = """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
  FROM latest_lines"""


def _line_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "l_orderkey", whole("l_linenumber"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
    )


@query("latest_wins", f"WITH {LATEST_LINES} {_LINE_OUT}")
def newest_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _line_columns(latest_lines(spark, sf))


@query(
    "duplicate_keys",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS cnt
  FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def line_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(table(spark, sf, "lineitem"), LINE_KEYS).select(
        "l_orderkey", whole("l_linenumber"), "cnt"
    )


@query("append_then_dedup", f"WITH {LATEST_LINES} {_LINE_OUT}")
def append_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Later shipments arrive as a batch on a table of earlier ones, partitioned by a key column."""
    path = scratch_path(spark, "append_then_dedup")
    lines = table(spark, sf, "lineitem")
    cut = F.lit("1998-07-01 00:00:00").cast("timestamp_ntz")
    append_at(lines.where(F.col("l_shipdate") < cut), path, "l_linenumber")
    batch = lines.where(~F.coalesce(F.col("l_shipdate") < cut, F.lit(False)))
    stored = spark.read.schema(lines.schema).parquet(path)
    target = touched(stored, batch, "l_linenumber")
    overwrite_partitions_at(
        append_then_dedup(target, batch, LINE_KEYS, "l_shipdate", LINE_TIES), path, "l_linenumber"
    )
    return _line_columns(spark.read.schema(lines.schema).parquet(path))


# --- rolling metrics -----------------------------------------------------------------------

_SERIES = "PARTITION BY symbol ORDER BY trade_date"


def _metrics_sql(value: str, means: tuple[int, ...], volatility: int, source: str) -> str:
    averages = ", ".join(
        f"avg({value}) OVER (s ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS ma_{n}_{value}"
        for n in means
    )
    return f"""returns AS (
  SELECT *, ({value} - lag({value}) OVER s) / nullif(lag({value}) OVER s, 0) AS daily_return, {averages}
  FROM {source} WINDOW s AS ({_SERIES})),
metrics AS (
  SELECT *, stddev_samp(daily_return) OVER (s ROWS BETWEEN {volatility - 1} PRECEDING AND CURRENT ROW)
            AS volatility_{volatility}
  FROM returns WINDOW s AS ({_SERIES}))"""


_METRICS = _metrics_sql("close", (5, 20), 20, "bars")
_DAY = "strftime(trade_date, '%Y-%m-%d') AS trade_date"


@query(
    "daily_return",
    f"WITH {BARS}, {_METRICS} SELECT symbol, {_DAY}, round(daily_return, 6) AS daily_return FROM metrics",
)
def daily_return(spark: SparkSession, sf: str) -> DataFrame:
    metrics = add_rolling(bars(spark, sf), RollingSpec())
    return metrics.select("symbol", text("trade_date"), rounded("daily_return"))


@query(
    "rolling_mean",
    f"""WITH {BARS}, {_METRICS} SELECT symbol, {_DAY}, round(ma_5_close, 6) AS ma_5_close,
  round(ma_20_close, 6) AS ma_20_close FROM metrics""",
)
def rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    metrics = add_rolling(bars(spark, sf), RollingSpec())
    return metrics.select("symbol", text("trade_date"), rounded("ma_5_close"), rounded("ma_20_close"))


@query(
    "rolling_volatility",
    f"WITH {BARS}, {_METRICS} SELECT symbol, {_DAY}, round(volatility_20, 6) AS volatility_20 FROM metrics",
)
def rolling_volatility(spark: SparkSession, sf: str) -> DataFrame:
    metrics = add_rolling(bars(spark, sf), RollingSpec())
    return metrics.select("symbol", text("trade_date"), rounded("volatility_20"))


_SERIES_SPEC = RollingSpec(value="value", means=(7, 30), volatility=30)


@query(
    "rolling_7_30",
    f"""WITH {PRICES}, {_metrics_sql("value", (7, 30), 30, "prices")}
  SELECT symbol, {_DAY}, value, round(daily_return, 6) AS daily_return, round(ma_7_value, 6) AS ma_7_value,
         round(ma_30_value, 6) AS ma_30_value, round(volatility_30, 6) AS volatility_30 FROM metrics""",
)
def rolling_7_30(spark: SparkSession, sf: str) -> DataFrame:
    metrics = add_rolling(prices(spark, sf), _SERIES_SPEC)
    return metrics.select(
        "symbol", text("trade_date"), "value", rounded("daily_return"), rounded("ma_7_value"),
        rounded("ma_30_value"), rounded("volatility_30"),
    )


@query(
    "calendar_avg",
    f"""WITH {PRICES}, c AS (SELECT symbol, trade_date, round(value * 100) AS cents FROM prices)
  SELECT symbol, {_DAY}, cents,
         avg(cents) OVER (PARTITION BY symbol, year(trade_date), month(trade_date)) AS monthly_avg_cents,
         avg(cents) OVER (PARTITION BY symbol, year(trade_date)) AS yearly_avg_cents
  FROM c""",
)
def calendar_avg(spark: SparkSession, sf: str) -> DataFrame:
    """Whole cents add up exactly, so the averages need no rounding to compare."""
    cents = prices(spark, sf).select("symbol", "trade_date", F.round(F.col("value") * 100).alias("cents"))
    averages = calendar_averages(cents, RollingSpec(value="cents"))
    return averages.select("symbol", text("trade_date"), "cents", "monthly_avg_cents", "yearly_avg_cents")


_CENTS = RollingSpec(value="cents")


@query(
    "calendar_avg_incremental",
    f"""WITH {PRICES}, c AS (SELECT symbol, year(trade_date) AS year, month(trade_date) AS month, CAST(round(value * 100) AS BIGINT) AS cents FROM prices),
  m AS (SELECT symbol, year, month, count(*) AS n_rows, count(cents) AS n, sum(cents) AS s FROM c GROUP BY 1, 2, 3)
  SELECT symbol, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, n_rows, CAST(s AS DOUBLE) / n AS monthly_avg_cents,
         CAST(sum(s) OVER y AS DOUBLE) / CAST(sum(n) OVER y AS DOUBLE) AS yearly_avg_cents
  FROM m WINDOW y AS (PARTITION BY symbol, year)""",
)
def calendar_avg_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Averages kept by two runs, the second one twice, over all prices.

    The first run has the days before 1999 but for late rows, and a wrong value where the lot is 1. The second brings
    the later days and the late rows, and the right values in place of the wrong ones.
    """
    day, first_lot = F.col("trade_date"), F.coalesce(F.col("unit") == "USD/1", F.lit(False))
    every = prices(spark, sf).select("symbol", day, "unit", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    every = save_and_read(every, scratch_path(spark, "averages"))
    old, late = F.coalesce(day < F.lit("1999-01-01").cast("date"), F.lit(False)), F.coalesce(F.col("unit") == "USD/2", F.lit(False))
    wrong = every.where(old & first_lot).withColumn("cents", F.col("cents") + 100)
    name = f"averages_{uuid.uuid4().hex[:12]}.by_month"
    place = scratch_path(spark, "averages")
    refresh_averages(spark, name, _CENTS, "1999-01-01 00:00:00", every.where(old & ~late & ~first_lot).unionByName(wrong), location=place)
    for _ in range(2):
        came = every.where(~old | late | first_lot)
        refresh_averages(spark, name, _CENTS, "2002-01-01 00:00:00", came, wrong, location=place)
    kept = stored_averages(spark, name, _CENTS)
    return kept.select("symbol", whole("year"), whole("month"), "n_rows", "monthly_avg_cents", "yearly_avg_cents")


@query(
    "rolling_ticks",
    """WITH returns AS (
  SELECT event_id, event_type AS symbol, value, ts,
         (value - lag(value) OVER s) / nullif(lag(value) OVER s, 0) AS daily_return,
         avg(value) OVER (s ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ma_5_value,
         avg(value) OVER (s ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS ma_20_value
  FROM events WINDOW s AS (PARTITION BY event_type ORDER BY ts, event_id))
  SELECT event_id, symbol, round(daily_return, 6) AS daily_return, round(ma_5_value, 6) AS ma_5_value,
         round(ma_20_value, 6) AS ma_20_value,
         round(stddev_samp(daily_return) OVER (PARTITION BY symbol ORDER BY ts, event_id
               ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS volatility_20
  FROM returns""",
)
def rolling_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Five series however large the data: they are cut into pieces of equal size, computed in many tasks."""
    ticks = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("symbol"), "ts", "value"
    )
    spec = RollingSpec(order="ts", value="value", ties=("event_id",))
    return rolling_in_pieces(ticks, spec).select(
        "event_id", "symbol", rounded("daily_return"), rounded("ma_5_value"), rounded("ma_20_value"),
        rounded("volatility_20"),
    )


@query(
    "incremental_window",
    f"""WITH {BARS}, {_METRICS}
  SELECT symbol, {_DAY}, close, round(daily_return, 6) AS daily_return, round(ma_5_close, 6) AS ma_5_close,
         round(ma_20_close, 6) AS ma_20_close, round(volatility_20, 6) AS volatility_20
  FROM metrics
  WHERE trade_date >= (SELECT CAST(min(ts) AS DATE) FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00')""",
)
def incremental_window(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of the dates a late batch touches, from a fact table partitioned by date."""
    path = scratch_path(spark, "incremental_window")
    fact = bars(spark, sf).drop("ingested_at")
    overwrite_partitions_at(fact, path, "trade_date")
    batch = table(spark, sf, "events").where(
        F.col("ts") >= F.lit("2024-01-24 00:00:00").cast("timestamp_ntz")
    )
    since = batch.agg(F.min(F.col("ts").cast("date"))).first()[0]
    stored = spark.read.schema(fact.schema).parquet(path)
    return _shown(refresh_rolling(stored, since, RollingSpec()))


def _shown(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "symbol", text("trade_date"), "close", rounded("daily_return"), rounded("ma_5_close"),
        rounded("ma_20_close"), rounded("volatility_20"),
    )


# changed rows of each symbol: one late one near the start, and the last one
_CHANGED = """changed AS (
  SELECT symbol, CASE WHEN k = 0 THEN min(trade_date) ELSE max(trade_date) END AS trade_date
  FROM bars, (SELECT unnest([0, 1]) AS k) WHERE symbol LIKE '%3' OR (symbol LIKE '%4' AND k = 1) GROUP BY symbol, k),
spans AS (SELECT symbol, min(trade_date) AS low, max(trade_date) AS high FROM changed GROUP BY symbol)"""


@query(
    "refresh_changed",
    f"""WITH {BARS}, {_METRICS}, {_CHANGED}
  SELECT m.symbol, strftime(m.trade_date, '%Y-%m-%d') AS trade_date, close, round(daily_return, 6) AS daily_return,
         round(ma_5_close, 6) AS ma_5_close, round(ma_20_close, 6) AS ma_20_close, round(volatility_20, 6) AS volatility_20
  FROM metrics m JOIN spans s ON m.symbol = s.symbol AND m.trade_date >= s.low
  QUALIFY count(*) FILTER (m.trade_date > s.high) OVER (PARTITION BY m.symbol ORDER BY m.trade_date) <= 20""",
)
def refreshed(spark: SparkSession, sf: str) -> DataFrame:
    """Only the symbols of a batch, from their first changed row on; an old late row doesn't touch the others."""
    path = scratch_path(spark, "refresh_changed")
    fact = bars(spark, sf).drop("ingested_at")
    overwrite_partitions_at(fact, path, "trade_date")
    stored = spark.read.schema(fact.schema).parquet(path)
    ends = fact.groupBy("symbol").agg(F.min("trade_date").alias("low"), F.max("trade_date").alias("high"))
    late = ends.where("symbol LIKE '%3'").select("symbol", F.explode(F.array("low", "high")).alias("trade_date"))
    last = ends.where("symbol LIKE '%4'").select("symbol", F.col("high").alias("trade_date"))
    return _shown(refresh_changed(stored, late.unionByName(last), RollingSpec())[0])


@query(
    "topk_recent",
    f"""WITH {BARS}, {_METRICS}
  SELECT symbol, {_DAY}, close, round(ma_5_close, 6) AS ma_5_close, round(volatility_20, 6) AS volatility_20
  FROM metrics WHERE symbol = 'U7' ORDER BY metrics.trade_date DESC LIMIT 10""",
)
def topk_recent(spark: SparkSession, sf: str) -> DataFrame:
    metrics = add_rolling(bars(spark, sf), RollingSpec())
    return most_recent(
        metrics, "U7",
        ["symbol", text("trade_date"), "close", rounded("ma_5_close"), rounded("volatility_20")],
    )
