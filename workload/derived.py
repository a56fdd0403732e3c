"""Base tables of the reference's kinds, derived from the test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.dedup import latest_wins
from stratalake.operators.merge import scd2_merge
from stratalake.operators.reports import host_of
from stratalake.operators.standardize import with_history_columns
from stratalake.session import save_and_read, scratch_path

from .registry import table

# --- daily bars per user: first/last value by event number, extremes, count -------


def bars(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return (
        events.groupBy("user_id", F.col("ts").cast("date").alias("trade_date"))
        .agg(
            F.min_by("value", "event_id").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", "event_id").alias("close"),
            F.count(F.lit(1)).alias("volume"),
            F.max("ts").alias("ingested_at"),
        )
        .withColumn("symbol", F.concat(F.lit("U"), F.col("user_id").cast("string")))
        .select("symbol", "trade_date", "open", "high", "low", "close", "volume", "ingested_at")
    )


BARS = """bars AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS trade_date,
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close, count(*) AS volume, max(ts) AS ingested_at
  FROM events GROUP BY 1, 2)"""


# --- hourly bars per event type ----------------------------------------------------


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return events.groupBy(
        F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("market_time")
    ).agg(
        F.min_by("value", "event_id").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "event_id").alias("close"),
    )


HOURLY = """hourly AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS market_time,
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close
  FROM events GROUP BY 1, 2)"""


# --- price series per part type and brand ------------------------------------------


def prices(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem").select(
        "l_partkey", "l_shipdate", "l_extendedprice", "l_linenumber"
    )
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    return (
        line.join(part, line.l_partkey == part.p_partkey)
        .groupBy("p_type", "p_brand", F.col("l_shipdate").cast("date").alias("trade_date"))
        .agg(
            F.max("l_extendedprice").alias("value"),
            F.min("l_linenumber").alias("lot"),
        )
        .select(
            F.col("p_type").alias("commodity"),
            F.concat_ws("/", "p_type", "p_brand").alias("symbol"),
            F.lit("daily").alias("interval"),
            "trade_date",
            "value",
            F.concat(F.lit("USD/"), F.col("lot").cast("string")).alias("unit"),
        )
    )


PRICES = """prices AS (
  SELECT p_type AS commodity, p_type || '/' || p_brand AS symbol, 'daily' AS "interval",
         CAST(l_shipdate AS DATE) AS trade_date, max(l_extendedprice) AS value,
         'USD/' || CAST(min(l_linenumber) AS VARCHAR) AS unit
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type, p_brand, 4)"""


# --- order state per customer and priority, in three batches ------------------------

VERSION_KEYS = ("custkey", "priority")
BATCH_TIMES = ("1997-01-01 00:00:00", "1999-01-01 00:00:00", "2001-09-01 00:00:00")


def order_state(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("ingested_at"),
        F.col("o_orderkey").alias("orderkey"),
    )


def version_batch(spark: SparkSession, sf: str, number: int) -> DataFrame:
    """The newest order state per key among the orders of one period; the last takes all later ones, and undated ones."""
    period = F.lit(len(BATCH_TIMES) - 1)
    for i in reversed(range(len(BATCH_TIMES) - 1)):
        before = F.col("ingested_at") < F.lit(BATCH_TIMES[i]).cast("timestamp_ntz")
        period = F.when(before, i).otherwise(period)
    rows = order_state(spark, sf).where(period == number)
    newest = latest_wins(rows, VERSION_KEYS, "ingested_at", ["orderkey"])
    return with_history_columns(
        newest.select(*VERSION_KEYS, "status", "ingested_at"),
        [*VERSION_KEYS, "status"],
        BATCH_TIMES[number],
    )


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """The versioned table after three runs; every run starts from the stored result of the last."""
    out = version_batch(spark, sf, 0)
    for number in (1, 2):
        stored = save_and_read(out, scratch_path(spark, "versions"))
        out = scd2_merge(stored, version_batch(spark, sf, number), VERSION_KEYS)
    return save_and_read(out, scratch_path(spark, "versions"))


VERSIONS = f"""states AS (
  SELECT o_custkey AS custkey, o_orderpriority AS priority, o_orderstatus AS status, o_totalprice AS amount,
         o_orderdate AS changed_at, o_orderkey AS orderkey,
         CASE WHEN o_orderdate < TIMESTAMP '{BATCH_TIMES[0]}' THEN '{BATCH_TIMES[0]}'
              WHEN o_orderdate < TIMESTAMP '{BATCH_TIMES[1]}' THEN '{BATCH_TIMES[1]}'
              ELSE '{BATCH_TIMES[2]}' END AS batch
  FROM orders),
newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY custkey, priority, batch
                                              ORDER BY changed_at DESC, orderkey DESC) AS rn FROM states) WHERE rn = 1),
changes AS (
  SELECT * FROM (SELECT *, lag(status) OVER (PARTITION BY custkey, priority ORDER BY batch) AS prev FROM newest)
  WHERE prev IS NULL OR prev <> status),
versions AS (
  SELECT custkey, priority, status, batch AS effective_from,
         lead(batch) OVER (PARTITION BY custkey, priority ORDER BY batch) AS effective_to,
         lead(batch) OVER (PARTITION BY custkey, priority ORDER BY batch) IS NULL AS is_current,
         sha256(concat_ws('||', CAST(custkey AS VARCHAR), priority, status)) AS record_hash
  FROM changes)"""


# --- indicators per customer (sparse) or nation, and year ---------------------------

# order priorities stand for indicator codes; the last is not part of the index
INDICATOR_OF = {
    "1-URGENT": "BCA_NGDPD",
    "2-HIGH": "PCPIPCH",
    "3-MEDIUM": "NGDP_RPCH",
    "4-NOT SPECIFIED": "LUR",
    "5-LOW": "OTHER",
}


def indicators(spark: SparkSession, sf: str, level: str = "customer") -> DataFrame:
    """Largest settled order per indicator, country and year; NULL where none is settled."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderdate", "o_orderstatus", "o_totalprice"
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey)
    country = F.col("c_name")
    if level == "nation":
        nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
        rows = rows.join(nation, rows.c_nationkey == nation.n_nationkey)
        country = F.col("n_name")
    code = F.lit(None).cast("string")
    for priority, name in INDICATOR_OF.items():
        code = F.when(F.col("o_orderpriority") == priority, name).otherwise(code)
    return rows.groupBy(
        code.alias("indicator"), country.alias("country"), F.year("o_orderdate").alias("year")
    ).agg(F.max(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))).alias("value"))


_CODE = (
    "CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN '{c}'" for p, c in INDICATOR_OF.items())
    + " END"
)


def _indicators_sql(country: str, join: str) -> str:
    return f"""ind AS (
  SELECT {_CODE} AS indicator, {country} AS country, year(o_orderdate) AS year,
         max(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) AS value
  FROM orders JOIN customer ON o_custkey = c_custkey {join} GROUP BY 1, 2, 3)"""


INDICATORS = _indicators_sql("c_name", "")
NATION_INDICATORS = _indicators_sql("n_name", "JOIN nation ON c_nationkey = n_nationkey")

NORMS = """norms AS (
  SELECT *, CASE WHEN max_v = min_v THEN 50.0 ELSE (value - min_v) / (max_v - min_v) * 100 END AS norm
  FROM (SELECT *, min(value) OVER (PARTITION BY indicator, year) AS min_v,
                  max(value) OVER (PARTITION BY indicator, year) AS max_v FROM ind))"""

WIDE = """bca AS (SELECT country, year, norm AS bca FROM norms WHERE indicator = 'BCA_NGDPD'),
pcpi AS (SELECT country, year, norm AS pcpi FROM norms WHERE indicator = 'PCPIPCH'),
gdp AS (SELECT country, year, norm AS gdp FROM norms WHERE indicator = 'NGDP_RPCH'),
lur AS (SELECT country, year, norm AS lur FROM norms WHERE indicator = 'LUR'),
wide AS (SELECT * FROM bca FULL JOIN pcpi USING (country, year)
         FULL JOIN gdp USING (country, year) FULL JOIN lur USING (country, year))"""

SCORES = """scores AS (
  SELECT country, year, coalesce(bca, 50.0) AS trade_exposure_score, coalesce(pcpi, 50.0) AS competitiveness_score,
         0.6 * coalesce(gdp, 50.0) + 0.4 * coalesce(lur, 50.0) AS macro_resilience_score,
         50.0 AS financial_sensitivity_score,
         (CAST(bca IS NOT NULL AS INT) + CAST(pcpi IS NOT NULL AS INT)
          + CAST(gdp IS NOT NULL AS INT) + CAST(lur IS NOT NULL AS INT)) / 4.0 AS coverage_ratio
  FROM wide),
idx AS (
  SELECT *, 0.35 * trade_exposure_score + 0.20 * competitiveness_score
            + 0.25 * macro_resilience_score + 0.20 * financial_sensitivity_score AS tvi_score FROM scores)"""


# --- articles from web pages ----------------------------------------------------------


def page_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Title and language from the page, host as the news source, the whole page as text."""
    day = F.regexp_extract("url", "/([0-9]+)", 1).try_cast("int")
    return table(spark, sf, "pages").select(
        F.col("url").alias("article_url"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_extract("html", "<html lang=\"([a-z]+)\"", 1).alias("language"),
        host_of("url").alias("source_news"),
        F.col("html").alias("description"),
        F.date_add(F.lit("2024-01-01").cast("date"), day).cast("timestamp").alias("published_at"),
    )


ARTICLES = """articles AS (
  SELECT url AS article_url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
         regexp_extract(html, '<html lang="([a-z]+)"', 1) AS language,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) AS source_news,
         html AS description,
         CAST(DATE '2024-01-01' + TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS INT) AS TIMESTAMP) AS published_at
  FROM pages)"""


# --- duplicate line items ------------------------------------------------------------

LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_TIES = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
)


def latest_lines(spark: SparkSession, sf: str) -> DataFrame:
    return latest_wins(table(spark, sf, "lineitem"), LINE_KEYS, "l_shipdate", LINE_TIES)


_LINE_ORDER = ", ".join(f"{c} DESC" for c in ("l_shipdate", *LINE_TIES))
LATEST_LINES = f"""latest_lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn
    FROM lineitem) WHERE rn = 1)"""
