"""Versioned tables, upserts and publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.dedup import latest_wins
from stratalake.operators.merge import (
    scd2_as_of,
    scd2_current,
    scd2_history,
    scd2_reopen,
    scd2_violations,
    upsert,
)
from stratalake.operators.quality import history_report
from stratalake.plans.manifest import run_history
from stratalake.session import scratch_path
from stratalake.sources.tables import overwrite_partitions_at, overwrite_snapshot_at

from .derived import BARS, BATCH_TIMES, VERSION_KEYS, VERSIONS, bars, order_state, versions
from .registry import moment, query, text

_OUT = "custkey, priority, status, effective_from, effective_to, is_current, record_hash"
SECOND, THIRD = BATCH_TIMES[1], BATCH_TIMES[2]


def _shown(df: DataFrame) -> DataFrame:
    return df.select(
        *VERSION_KEYS, "status", moment("effective_from"), moment("effective_to"), "is_current", "record_hash"
    )


@query("scd2_merge", f"WITH {VERSIONS} SELECT {_OUT} FROM versions")
def merged(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(versions(spark, sf))


@query("scd2_current", f"WITH {VERSIONS} SELECT {_OUT} FROM versions WHERE is_current")
def current(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(scd2_current(versions(spark, sf)))


@query(
    "scd2_history",
    f"""WITH {VERSIONS} SELECT {_OUT} FROM versions
  WHERE (custkey, priority) IN (SELECT (custkey, priority) FROM versions GROUP BY custkey, priority HAVING count(*) > 1)""",
)
def history(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(scd2_history(versions(spark, sf), VERSION_KEYS))


@query(
    "scd2_as_of",
    f"""WITH {VERSIONS}
  SELECT custkey, priority, status, effective_from,
         CASE WHEN effective_to <= '{SECOND}' THEN effective_to END AS effective_to,
         effective_to IS NULL OR effective_to > '{SECOND}' AS is_current, record_hash
  FROM versions WHERE effective_from <= '{SECOND}'""",
)
def as_of(spark: SparkSession, sf: str) -> DataFrame:
    """The table rolled back to the second run."""
    return _shown(scd2_as_of(versions(spark, sf), SECOND))


_REOPENED = f"""reopened AS (
  SELECT custkey, priority, status,
         CASE WHEN hit THEN '2001-12-01 00:00:00' ELSE effective_from END AS effective_from,
         CASE WHEN hit THEN NULL ELSE effective_to END AS effective_to, is_current OR hit AS is_current, record_hash
  FROM (SELECT *, priority = '1-URGENT' AND status = 'F' AND NOT is_current AS hit FROM versions))"""


def _reopened(spark: SparkSession, sf: str) -> DataFrame:
    chosen = (F.col("priority") == "1-URGENT") & (F.col("status") == "F")
    return scd2_reopen(versions(spark, sf), chosen, "2001-12-01 00:00:00")


@query("scd2_reopen", f"WITH {VERSIONS}, {_REOPENED} SELECT {_OUT} FROM reopened")
def reopened(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_reopened(spark, sf))


@query(
    "scd2_multi_current",
    f"""WITH {VERSIONS}, {_REOPENED}
  SELECT custkey, priority, CAST(sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS BIGINT) AS current_rows
  FROM reopened GROUP BY 1, 2 HAVING sum(CASE WHEN is_current THEN 1 ELSE 0 END) > 1""",
)
def multi_current(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_violations(_reopened(spark, sf), VERSION_KEYS).where("current_rows > 1")


@query(
    "scd2_missing_current",
    f"""WITH {VERSIONS}
  SELECT custkey, priority FROM versions WHERE effective_from < '{THIRD}'
  GROUP BY 1, 2 HAVING sum(CASE WHEN is_current THEN 1 ELSE 0 END) = 0""",
)
def missing_current(spark: SparkSession, sf: str) -> DataFrame:
    """Rows closed by the last run without their successors, as a broken merge leaves them."""
    broken = versions(spark, sf).where(F.col("effective_from") < F.lit(THIRD).cast("timestamp"))
    return scd2_violations(broken, VERSION_KEYS).where("current_rows = 0").select(*VERSION_KEYS)


@query(
    "scd2_invariants",
    f"""WITH {VERSIONS}, {_REOPENED}, good AS (
  SELECT sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS m, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) AS z
  FROM (SELECT sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS n FROM versions GROUP BY custkey, priority)),
bad AS (
  SELECT sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS m, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) AS z
  FROM (SELECT sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS n FROM reopened GROUP BY custkey, priority))
  SELECT 'merged' AS state, 'multiple_current' AS "check", CAST(m AS BIGINT) AS violations FROM good
  UNION ALL SELECT 'merged', 'missing_current', CAST(z AS BIGINT) FROM good
  UNION ALL SELECT 'reopened', 'multiple_current', CAST(m AS BIGINT) FROM bad
  UNION ALL SELECT 'reopened', 'missing_current', CAST(z AS BIGINT) FROM bad""",
)
def invariants(spark: SparkSession, sf: str) -> DataFrame:
    good = history_report(versions(spark, sf), VERSION_KEYS).withColumn("state", F.lit("merged"))
    bad = history_report(_reopened(spark, sf), VERSION_KEYS).withColumn("state", F.lit("reopened"))
    return good.unionByName(bad).select("state", "check", "violations")


@query(
    "run_history",
    f"""WITH {VERSIONS}, o AS (SELECT effective_from AS run_at, count(*) AS n FROM versions GROUP BY 1),
c AS (SELECT effective_to AS run_at, count(*) AS n FROM versions WHERE effective_to IS NOT NULL GROUP BY 1)
  SELECT run_at, CAST(coalesce(o.n, 0) AS BIGINT) AS opened, CAST(coalesce(c.n, 0) AS BIGINT) AS closed,
         CAST(coalesce(o.n, 0) - coalesce(c.n, 0) AS BIGINT) AS net_current
  FROM o FULL JOIN c USING (run_at)""",
)
def runs(spark: SparkSession, sf: str) -> DataFrame:
    return run_history(versions(spark, sf)).select(moment("run_at"), "opened", "closed", "net_current")


# --- upserts --------------------------------------------------------------------------------

_SPLIT = "1998-04-01 00:00:00"


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Newest state per key before and after the split; the first half is the stored fact."""
    orders = order_state(spark, sf)
    cut = F.lit(_SPLIT).cast("timestamp_ntz")

    def newest(rows: DataFrame) -> DataFrame:
        return latest_wins(rows, VERSION_KEYS, "ingested_at", ["orderkey"]).select(
            *VERSION_KEYS, "status", "amount"
        )

    old = newest(orders.where(F.col("ingested_at") < cut)).withColumn(
        "processed_at", F.lit("1998-04-01 00:00:00").cast("timestamp")
    )
    return old, newest(orders.where(~F.coalesce(F.col("ingested_at") < cut, F.lit(False))))


def _upsert_sql(status: str) -> str:
    return f"""WITH s AS (
  SELECT o_custkey AS custkey, o_orderpriority AS priority, o_orderstatus AS status, o_totalprice AS amount,
         o_orderdate < TIMESTAMP '{_SPLIT}' AS old,
         row_number() OVER (PARTITION BY o_custkey, o_orderpriority, o_orderdate < TIMESTAMP '{_SPLIT}'
                            ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
t AS (SELECT * FROM s WHERE rn = 1 AND old), n AS (SELECT * FROM s WHERE rn = 1 AND NOT old)
  SELECT custkey, priority, {status} AS status, coalesce(n.amount, t.amount) AS amount,
         CASE WHEN n.custkey IS NULL THEN '1998-04-01 00:00:00' ELSE '2001-09-01 00:00:00' END AS processed_at
  FROM t FULL JOIN n USING (custkey, priority)"""


def _upserted(spark: SparkSession, sf: str, update: list[str]) -> DataFrame:
    old, new = _halves(spark, sf)
    out = upsert(old, new, VERSION_KEYS, update, "processed_at", "2001-09-01 00:00:00")
    return out.select(*VERSION_KEYS, "status", "amount", moment("processed_at"))


@query("upsert_all_measures", _upsert_sql("coalesce(n.status, t.status)"))
def upsert_all(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf, ["status", "amount"])


@query("upsert_subset", _upsert_sql("coalesce(t.status, n.status)"))
def upsert_some(spark: SparkSession, sf: str) -> DataFrame:
    """Only the amount is updated; the status stays as first inserted."""
    return _upserted(spark, sf, ["amount"])


# --- publishing -----------------------------------------------------------------------------


@query(
    "snapshot_overwrite",
    f"WITH {VERSIONS} SELECT custkey, priority, status, effective_from FROM versions WHERE is_current",
)
def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A fact replaced as a whole: the second publish leaves nothing of the first."""
    path = scratch_path(spark, "snapshot_overwrite")
    table_ = versions(spark, sf)
    fact = ["custkey", "priority", "status", "effective_from"]
    overwrite_snapshot_at(table_.select(*fact), path)
    overwrite_snapshot_at(scd2_current(table_).select(*fact), path)
    return spark.read.schema(table_.select(*fact).schema).parquet(path).select(
        "custkey", "priority", "status", moment("effective_from")
    )


@query(
    "partition_overwrite",
    f"""WITH {BARS} SELECT symbol, strftime(trade_date, '%Y-%m-%d') AS trade_date, close,
  CASE WHEN trade_date >= DATE '2024-01-20' THEN 'second' ELSE 'first' END AS published FROM bars""",
)
def partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The second publish replaces its own dates only."""
    path = scratch_path(spark, "partition_overwrite")
    fact = bars(spark, sf).select("symbol", "trade_date", "close")
    first = fact.withColumn("published", F.lit("first"))
    overwrite_partitions_at(first, path, "trade_date")
    late = fact.where(F.col("trade_date") >= F.lit("2024-01-20").cast("date"))
    overwrite_partitions_at(late.withColumn("published", F.lit("second")), path, "trade_date")
    stored = spark.read.schema(first.schema).parquet(path)
    return stored.select("symbol", text("trade_date"), "close", "published")
