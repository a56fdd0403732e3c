"""Scans, sinks, gates, manifests and whole jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.flatten import FLATTENERS
from stratalake.operators.quality import (
    GateError,
    cast_failed,
    missing_columns,
    not_recent,
    outside_domain,
    outside_range,
    quality_report,
    row_report,
)
from stratalake.plans.ingest import ingest
from stratalake.plans.jobs import Layers, Run, roll_back, run_dataset, run_manifest
from stratalake.plans.manifest import manifest_gate, manifest_reconcile
from stratalake.plans.registry import ALL_DATASETS, ARTICLE_COLUMNS, DATASETS
from stratalake.functions.casting import cast_or_null
from stratalake.session import save_and_read, scratch_path
from stratalake.sources.bronze import (
    run_name,
    scan_bronze,
    scan_raw_zone,
    split_corrupt,
    write_per_entity,
    write_raw_zone,
)
from stratalake.operators.reports import preview
from stratalake.sources import tables
from stratalake.sources.tables import layer_counts

from .derived import (
    BARS,
    INDICATORS,
    LATEST_LINES,
    LINE_KEYS,
    NORMS,
    PRICES,
    SCORES,
    WIDE,
    bars,
    hourly,
    indicators,
    latest_lines,
    prices,
)
from .market import _METRICS
from .payloads import _REJECTING, _date_map_raw
from .registry import moment, query, rounded, table, text, whole

INGESTED = "2024-02-01T00:00:00+00:00"


def _bronze_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Bars as bronze lines."""
    return bars(spark, sf).select(
        "symbol", F.col("trade_date").cast("string").alias("trade_date"), "open", "high", "low", "close", "volume",
        F.lit("alphavantage").alias("source"), F.lit("time_series_daily").alias("dataset"),
        F.lit("/query").alias("request_url"), F.lit(INGESTED).alias("received_at"),
    )


# --- scans --------------------------------------------------------------------------------------


@query(
    "scan_failfast",
    f"WITH {BARS} SELECT symbol, strftime(trade_date, '%Y-%m-%d') AS trade_date, close, volume, 'alphavantage' AS source FROM bars",
)
def scan_strict(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "scan_failfast")
    _bronze_bars(spark, sf).write.json(path)
    lines = scan_bronze(spark, [path], ["symbol", "trade_date", "close", "volume", "source"])
    return lines.select(
        "symbol", "trade_date", cast_or_null("close", "double").alias("close"),
        cast_or_null("volume", "bigint").alias("volume"), "source",
    )


@query(
    "scan_key_gate",
    f"""WITH {BARS} SELECT 'named' AS objects, count(*) AS n, count(DISTINCT symbol) AS symbols FROM bars
  UNION ALL SELECT 'no object keys given', 0, 0""",
)
def scan_gated(spark: SparkSession, sf: str) -> DataFrame:
    """Objects that are named are read whole; a run that names none is refused, though its zone is full."""
    path = scratch_path(spark, "scan_key_gate")
    _bronze_bars(spark, sf).write.json(path)
    counts = [F.count(F.lit(1)).alias("n"), F.countDistinct("symbol").alias("symbols")]
    read = scan_bronze(spark, [path], ["symbol", "trade_date"]).agg(F.lit("named").alias("objects"), *counts)
    try:
        refused = scan_bronze(spark, [], ["symbol", "trade_date"], base_path=path).agg(F.lit("all").alias("objects"), *counts)
    except ValueError as problem:
        refused = read.select(F.lit(str(problem)).alias("objects"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("symbols"))
    return read.unionByName(refused)


@query(
    "scan_permissive",
    """SELECT event_type, CASE WHEN event_type = 'error' THEN 'quarantined' ELSE 'good' END AS kind, count(*) AS n
  FROM events GROUP BY 1, 2""",
)
def scan_tolerant(spark: SparkSession, sf: str) -> DataFrame:
    """Truncated lines are set aside whole, the rest is read."""
    path = scratch_path(spark, "scan_permissive")
    events = table(spark, sf, "events")
    line = F.to_json(F.struct("event_type", "event_id"))
    cut = F.regexp_replace(line, ",.*$", ",")
    events.select(F.when(F.col("event_type") == "error", cut).otherwise(line)).write.text(path)
    good, bad = split_corrupt(scan_bronze(spark, [path], ["event_type", "event_id"], "PERMISSIVE"))
    told = F.regexp_extract("_corrupt_record", '"event_type":"([a-z]+)"', 1)
    rows = good.select("event_type", F.lit("good").alias("kind")).unionByName(
        bad.select(told.alias("event_type"), F.lit("quarantined").alias("kind"))
    )
    return rows.groupBy("event_type", "kind").agg(F.count(F.lit(1)).alias("n"))


def _landed_articles(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.concat(F.lit("https://news.example.com/"), F.col("doc_id").cast("string")).alias("Article_URL"),
        F.col("text").alias("description"),
        F.lit("newsapi").alias("source_api"),
        F.lit("2024-01-15T08:30:00Z").alias("Published_At"),
        F.col("source"),
        F.col("lang").alias("dataset"),
    )


@query(
    "raw_zone_scan",
    """SELECT 'https://news.example.com/' || CAST(doc_id AS VARCHAR) AS article_url, text AS description,
  '2024-01-15 08:30:00' AS published_at, source, lang AS dataset, '2024-02-01' AS ingestion_date
  FROM documents WHERE lang = 'en'""",
)
def zone_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A dataset filter prunes folders; member names match in any case."""
    base = scratch_path(spark, "raw_zone_scan")
    write_raw_zone(_landed_articles(spark, sf), base, INGESTED)
    zone = scan_raw_zone(spark, base, ARTICLE_COLUMNS).where("dataset = 'en'")
    utc = F.to_utc_timestamp("published_at", F.current_timezone())
    return zone.withColumn("published_at", utc).select(
        "article_url", "description", moment("published_at"), "source", "dataset", text("ingestion_date")
    )


@query(
    "raw_zone_write",
    """SELECT source, lang AS dataset, '2024-02-01' AS ingestion_date, count(*) AS records,
  CAST(sum(length(text)) AS BIGINT) AS characters FROM documents GROUP BY 1, 2""",
)
def zone_write(spark: SparkSession, sf: str) -> DataFrame:
    """What a plain partition-discovering reader finds after the write."""
    base = scratch_path(spark, "raw_zone_write")
    write_raw_zone(_landed_articles(spark, sf), base, INGESTED)
    schema = "description STRING, source STRING, dataset STRING, ingestion_date DATE"
    found = spark.read.schema(schema).json(base)
    return found.groupBy("source", "dataset", text("ingestion_date")).agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.length("description")).alias("characters")
    )


@query(
    "entity_fanout_counts",
    """SELECT o_orderpriority AS entity, count(*) AS record_count, count(*) AS stored FROM orders GROUP BY 1""",
)
def fan_out(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "entity_fanout")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.lit("shop").alias("source"), F.lit("orders").alias("dataset")
    )
    manifest = write_per_entity(orders, base, F.col("o_orderpriority"), INGESTED)
    schema = "o_orderkey BIGINT, source STRING, dataset STRING, ingestion_date DATE, entity STRING"
    stored = spark.read.schema(schema).json(base).groupBy("entity").agg(F.count("o_orderkey").alias("stored"))
    return manifest.join(stored, "entity").select("entity", "record_count", "stored")


@query(
    "layer_counts",
    f"""WITH {LATEST_LINES}
  SELECT 'bronze' AS layer, count(*) AS row_count FROM lineitem
  UNION ALL SELECT 'silver', count(*) FROM latest_lines
  UNION ALL SELECT 'gold', count(*) FROM (SELECT DISTINCT l_suppkey, l_shipdate FROM latest_lines)""",
)
def counts(spark: SparkSession, sf: str) -> DataFrame:
    silver = latest_lines(spark, sf)
    gold = silver.groupBy("l_suppkey", "l_shipdate").agg(F.max("l_extendedprice"))
    return layer_counts({"bronze": table(spark, sf, "lineitem"), "silver": silver, "gold": gold})


# --- gates ----------------------------------------------------------------------------------------


@query(
    "quality_report",
    """SELECT 'l_orderkey_present' AS "check", count(*) FILTER (l_orderkey IS NULL) AS violations FROM lineitem
  UNION ALL SELECT 'l_linenumber_present', count(*) FILTER (l_linenumber IS NULL) FROM lineitem
  UNION ALL SELECT 'discount_range', count(*) FILTER (NOT (l_discount BETWEEN 0 AND 0.05)) FROM lineitem
  UNION ALL SELECT 'flag_is_number', count(*) FILTER (TRY_CAST(l_returnflag AS DOUBLE) IS NULL) FROM lineitem
  UNION ALL SELECT 'not_empty', 0
  UNION ALL SELECT 'unique_keys', count(*) FROM
    (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def report(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.col("l_returnflag")
    checks = {
        "discount_range": outside_range("l_discount", 0, 0.05),
        "flag_is_number": cast_failed(flag, cast_or_null(flag, "double")),
    }
    return quality_report(table(spark, sf, "lineitem"), LINE_KEYS, checks)


@query(
    "quality_domain",
    """SELECT 'status' AS "check", count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS violations FROM orders
  UNION ALL SELECT 'priority', count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) FROM orders""",
)
def domains(spark: SparkSession, sf: str) -> DataFrame:
    checks = {
        "status": outside_domain("o_orderstatus", ["F", "O"]),
        "priority": outside_domain("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
    }
    return row_report(table(spark, sf, "orders"), checks, non_empty=False)


@query(
    "quality_recency",
    """SELECT 'ordered' AS "check", count(*) FILTER (o_orderdate < TIMESTAMP '2001-07-01 00:00:00'
    OR o_orderstatus = 'P') AS violations FROM orders""",
)
def recency(spark: SparkSession, sf: str) -> DataFrame:
    """Dates told as text, one kind in a wrong format."""
    told = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    orders = table(spark, sf, "orders").select(told.alias("ordered"))
    return row_report(orders, {"ordered": not_recent("ordered", "2001-07-31 00:00:00")}, non_empty=False)


# --- manifests --------------------------------------------------------------------------------------


@query(
    "manifest_gate",
    """WITH m AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
  SELECT strftime(day, '%Y-%m-%d') AS day, event_type AS kind,
    CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 0 ELSE n END AS record_count,
    CASE event_type WHEN 'error' THEN 'not successful' WHEN 'signup' THEN 'not json' WHEN 'purchase' THEN 'no records'
                    WHEN 'view' THEN 'missing field' END AS problem FROM m""",
)
def manifests(spark: SparkSession, sf: str) -> DataFrame:
    """A manifest per event type and day; each type stands for one way to be wrong, clicks are right."""
    kind = F.col("kind")
    daily = (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("kind"), F.col("ts").cast("date").cast("string").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    good = F.to_json(
        F.struct(
            F.when(kind == "error", "FAILED").otherwise("SUCCESS").alias("status"),
            F.lit(INGESTED).alias("lambda_exec_ts"),
            F.lit("web").alias("domain"),
            F.lit("events").alias("source"),
            kind.alias("dataset"),
            F.when(kind != "view", F.array(F.concat(F.lit("bronze/"), F.col("day")))).alias("keys"),
            F.when(kind != "purchase", F.col("n")).alias("record_count"),
            F.lit(INGESTED).alias("ingested_at"),
        )
    )
    told = F.when(kind == "signup", F.concat(F.lit("Task timed out on "), F.col("day"))).otherwise(good)
    gated = manifest_gate(daily.select("kind", "day", told.alias("manifest")))
    return gated.fillna(0, ["record_count"]).select("day", "kind", "record_count", "problem")


@query(
    "manifest_reconcile",
    f"""WITH {LATEST_LINES}, a AS (SELECT l_returnflag, l_linestatus, count(*) AS announced FROM lineitem GROUP BY 1, 2),
c AS (SELECT l_returnflag, l_linestatus, count(*) AS counted FROM latest_lines GROUP BY 1, 2)
  SELECT l_returnflag, l_linestatus, announced, counted, counted - announced AS difference
  FROM a JOIN c USING (l_returnflag, l_linestatus)""",
)
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Announced line items against those left after removing duplicates."""
    by = ["l_returnflag", "l_linestatus"]
    announced = table(spark, sf, "lineitem").groupBy(*by).agg(F.count(F.lit(1)).alias("record_count"))
    return manifest_reconcile(announced, latest_lines(spark, sf), by)


# --- whole jobs -----------------------------------------------------------------------------------------


def _own_layers(spark: SparkSession, label: str) -> Layers:
    """Databases of this call only, in the shared folder."""
    tag = uuid.uuid4().hex[:12]
    return Layers(
        f"silver_{tag}", f"gold_{tag}", f"ops_{tag}", location=scratch_path(spark, label)
    )


def _land(df: DataFrame, label: str) -> str:
    path = scratch_path(df.sparkSession, label)
    df.withColumn("ingested_at", F.lit(INGESTED)).write.json(path)
    return path


@query(
    "job_market",
    f"""WITH {BARS}, {_METRICS}
  SELECT symbol, strftime(trade_date, '%Y-%m-%d') AS trade_date, open, high, low, close, CAST(volume AS BIGINT) AS volume,
         round(daily_return, 6) AS daily_return, round(ma_5_close, 6) AS ma_5_close, round(ma_20_close, 6) AS ma_20_close,
         round(volatility_20, 6) AS volatility_20 FROM metrics""",
)
def market_job(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the market job; the second corrects and extends the first, metrics refresh in part."""
    spec, layers = DATASETS["market_daily"], _own_layers(spark, "job_market")
    lines = _bronze_bars(spark, sf)
    early = lines.where("trade_date < '2024-01-26'").withColumn(
        "close", F.when(F.col("trade_date") >= "2024-01-24", F.col("close") + 1).otherwise(F.col("close"))
    )
    late = lines.where("NOT coalesce(trade_date < '2024-01-24', false)")
    run_dataset(spark, spec, [_land(early, "land")], Run("run-1", "2024-01-26 06:00:00"), layers)
    run_dataset(spark, spec, [_land(late, "land")], Run("run-2", "2024-01-31 06:00:00"), layers)
    metrics = spark.table(spec.table(layers.gold, "metrics"))
    return metrics.select(
        "symbol", text("trade_date"), "open", "high", "low", "close", "volume", rounded("daily_return"),
        rounded("ma_5_close"), rounded("ma_20_close"), rounded("volatility_20"),
    )


@query(
    "job_macro",
    f"""WITH {INDICATORS}, {NORMS}, {WIDE}, {SCORES}
  SELECT country, CAST(year AS BIGINT) AS year, round(tvi_score, 6) AS tvi_score FROM idx""",
)
def macro_job(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the macro job, by period; the index covers both."""
    spec, layers = DATASETS["macro_indicators"], _own_layers(spark, "job_macro")
    lines = indicators(spark, sf).select(
        "indicator", "country", "year", "value", F.lit("imf").alias("source"), F.lit("indicators").alias("dataset"),
        F.lit("/api").alias("request_url"), F.lit(INGESTED).alias("received_at"),
    )
    lines = save_and_read(lines, scratch_path(spark, "lines"))  # both batches are cut from it
    run_dataset(spark, spec, [_land(lines.where("year < 1999"), "land")], Run("run-1", "1999-01-01 00:00:00"), layers)
    run_dataset(spark, spec, [_land(lines.where("NOT coalesce(year < 1999, false)"), "land")], Run("run-2", "2002-01-01 00:00:00"), layers)
    return spark.table(spec.table(layers.gold, "tvi")).select("country", whole("year"), rounded("tvi_score"))


@query(
    "job_exchange_rates",
    """SELECT event_type AS symbol, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS market_time,
  strftime(ts, '%Y-%m') AS year_month, arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, event_id) AS close FROM events GROUP BY 1, 2, 3""",
)
def exchange_rate_job(spark: SparkSession, sf: str) -> DataFrame:
    """The same batch delivered twice: the fact holds every key once."""
    spec, layers = DATASETS["exchange_rates"], _own_layers(spark, "job_exchange_rates")
    lines = hourly(spark, sf).select(
        "symbol", F.lit("1day").alias("interval"), F.lit("US Dollar").alias("currency_base"),
        F.lit("Rupee").alias("currency_quote"), F.lit("Physical Currency").alias("type"),
        F.date_format("market_time", "yyyy-MM-dd'T'HH:mm:ss").alias("market_time"),
        "open", "high", "low", "close", F.lit("twelvedata").alias("source"),
        F.lit("exchange_rates").alias("dataset"), F.lit("/time_series").alias("request_url"),
        F.lit(INGESTED).alias("received_at"),
    )
    path = _land(lines, "land")
    run_dataset(spark, spec, [path], Run("run-1", "2024-01-31 00:00:00"), layers)
    run_dataset(spark, spec, [path], Run("run-2", "2024-02-01 00:00:00"), layers)
    fact = spark.table(spec.table(layers.gold, "fact"))
    return fact.select("symbol", moment("market_time"), "year_month", "open", "high", "low", "close")


# --- ingestion ---------------------------------------------------------------------------------------


@query(
    "ingest_manifest",
    f"""WITH {BARS} SELECT 'SUCCESS' AS status, 'american_markets' AS domain, 'alphavantage' AS source,
  'time_series_daily' AS dataset, count(*) AS record_count, true AS has_keys,
  2 * (SELECT count(*) FROM (SELECT DISTINCT symbol, strftime(trade_date, '%Y-%m') FROM bars)) + 2 * (SELECT count(*) FROM region)
    AS rejected FROM bars""",
)
def ingestion(spark: SparkSession, sf: str) -> DataFrame:
    """Raw payloads with bad elements and failed responses become objects; the manifest counts the rows."""
    layers = _own_layers(spark, "ingest_manifest")
    base = scratch_path(spark, "ingest_zone")
    done = ingest(spark, DATASETS["market_daily"], _date_map_raw(spark, sf), base, INGESTED, layers)
    gated = manifest_gate(spark.range(1).select(F.lit(done.manifest).alias("manifest"))).where("problem IS NULL")
    kept = spark.table(f"{layers.ops}.rejected").agg(F.count(F.lit(1)).alias("rejected"))
    return gated.crossJoin(F.broadcast(kept)).select(  # one row each
        "status", "domain", "source", "dataset", "record_count", (F.size("keys") > 0).alias("has_keys"), "rejected"
    )


@query(
    "job_ingest_market",
    f"""WITH {BARS}, zeroed AS (SELECT * REPLACE (CASE WHEN volume = 1 THEN 0.0 ELSE low END AS low) FROM bars), {_METRICS}
  SELECT m.symbol, strftime(m.trade_date, '%Y-%m-%d') AS trade_date, m.open, m.high, z.low, m.close, CAST(m.volume AS BIGINT) AS volume,
         round(daily_return, 6) AS daily_return, round(ma_5_close, 6) AS ma_5_close, round(ma_20_close, 6) AS ma_20_close,
         round(volatility_20, 6) AS volatility_20 FROM metrics m JOIN zeroed z USING (symbol, trade_date)""",
)
def ingested_market(spark: SparkSession, sf: str) -> DataFrame:
    """From raw payloads to metrics: ingest, then the run that the manifest asks for."""
    spec, layers = DATASETS["market_daily"], _own_layers(spark, "job_ingest_market")
    base = scratch_path(spark, "ingest_zone")
    done = ingest(spark, spec, _date_map_raw(spark, sf), base, INGESTED, layers)
    run_manifest(spark, done.manifest, "run-1", "2024-02-01 06:00:00", layers, base_path=base)
    metrics = spark.table(spec.table(layers.gold, "metrics"))
    return metrics.select(
        "symbol", text("trade_date"), "open", "high", "low", "close", "volume", rounded("daily_return"),
        rounded("ma_5_close"), rounded("ma_20_close"), rounded("volatility_20"),
    )


@query(
    "ingest_replay",
    f"""WITH {BARS}, n AS (SELECT count(*) AS n FROM bars) SELECT step, n AS record_count, n AS zone_rows, n AS facts, true AS same_keys
  FROM n, (VALUES ('first'), ('replayed'), ('after a crash')) AS s(step)""",
)
def replayed_ingestion(spark: SparkSession, sf: str) -> DataFrame:
    """The same ingestion once, once more, and after a try that left rows but no manifest: the same folders, counts and facts."""
    spec, found = DATASETS["market_daily"], None
    raw = save_and_read(_date_map_raw(spark, sf), scratch_path(spark, "landed"))  # the responses land once
    for step in ("first", "replayed", "after a crash"):
        layers = _own_layers(spark, "ingest_replay")
        base = scratch_path(spark, "ingest_zone")
        if step == "after a crash":
            left = FLATTENERS[spec.flattener]().rows(raw).where("volume % 2 = 0")
            write_raw_zone(left, base, INGESTED, run=run_name(spec.name, INGESTED))
        done = ingest(spark, spec, raw, base, INGESTED, layers)
        keys = [k.split("/source=")[1] for k in done.keys]
        if step == "first":
            first = keys
        elif step == "replayed":
            done = ingest(spark, spec, raw, base, INGESTED, layers)
        run_manifest(spark, done.manifest, "run-1", "2024-02-01 06:00:00", layers, base_path=base)
        zone = spark.read.schema("symbol STRING, source STRING, dataset STRING, ingestion_date DATE").json(base)
        facts = spark.table(spec.table(layers.gold, "fact")).count()
        same = keys == first and keys == [k.split("/source=")[1] for k in done.keys]
        one = zone.agg(
            F.lit(step).alias("step"), F.lit(done.record_count).cast("bigint").alias("record_count"), F.count(F.lit(1)).alias("zone_rows"),
            F.lit(facts).cast("bigint").alias("facts"), F.lit(same).alias("same_keys"),
        )
        found = one if found is None else found.unionByName(one)
    return found


_ZONE_SETS = {"risk_premium": "supplier", "swings": "customer", "news_everything": "documents", "sector_historical": "customer"}


@query(
    "ingest_raw_datasets",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, CAST(count(*) * {2 if name == 'swings' else 1} AS BIGINT) AS record_count FROM {source}"
        for name, source in _ZONE_SETS.items()
    )
    + " UNION ALL SELECT 'trending', count(*) FROM events",
)
def raw_ingestion(spark: SparkSession, sf: str) -> DataFrame:
    """Datasets that end in the raw zone, by the registry's flatteners; counted in the zone."""
    layers, found = _own_layers(spark, "ingest_raw"), None
    base = scratch_path(spark, "ingest_zone")
    sources = {
        "risk_premium": _REJECTING["risk_premium"][1](spark, sf),
        "swings": _REJECTING["swings"][1](spark, sf),
        "news_everything": _REJECTING["articles"][1](spark, sf),
        "sector_historical": _REJECTING["performance"][1](spark, sf),
        "trending": table(spark, sf, "events").select(
            F.col("props").alias("payload"), F.lit("/trending?key=secret").alias("request_url"), F.lit(INGESTED).alias("received_at")
        ),
    }
    for name, raw in sources.items():
        spec = ALL_DATASETS[name]
        ingest(spark, spec, raw, base, INGESTED, layers)
        zone = spark.read.schema("request_url STRING, source STRING, dataset STRING, ingestion_date DATE").json(base)
        own = zone.where((F.col("source") == spec.source) & (F.col("dataset") == spec.dataset) & ~F.col("request_url").contains("secret"))
        one = own.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("record_count"))
        found = one if found is None else found.unionByName(one)
    return found


# --- what a refused run leaves, and what a roll back brings back ----------------------------------------


@query(
    "job_gate_report",
    f"""WITH {BARS}, early AS (SELECT * FROM bars WHERE trade_date < DATE '2024-01-20')
  SELECT 'run-1' AS run_id, 'done' AS status, count(*) AS bronze_rows, count(*) AS batch_rows, 0 AS low_failures, count(*) AS facts FROM early
  UNION ALL SELECT 'run-2', 'refused', (SELECT count(*) FROM bars WHERE trade_date >= DATE '2024-01-20'), 0,
    (SELECT count(*) FROM bars WHERE trade_date >= DATE '2024-01-20' AND volume = 1), count(*) FROM early
  UNION ALL SELECT 'run-3', 'done', (SELECT count(*) FROM bars WHERE trade_date >= DATE '2024-01-20'),
    (SELECT count(*) FROM bars WHERE trade_date >= DATE '2024-01-20'),
    (SELECT count(*) FROM bars WHERE trade_date >= DATE '2024-01-20' AND volume = 1), count(*) FROM bars""",
)
def gates(spark: SparkSession, sf: str) -> DataFrame:
    """A run announced with a wrong count is refused and changes nothing; values that don't convert are counted."""
    spec, layers = DATASETS["market_daily"], _own_layers(spark, "job_gate_report")
    lines = _bronze_bars(spark, sf)
    late = lines.where("trade_date >= '2024-01-20'").withColumn(
        "low", F.when(F.col("volume") == 1, F.lit("NaN")).otherwise(F.col("low").cast("string"))
    )
    early, later = _land(lines.where("trade_date < '2024-01-20'"), "land"), _land(late, "land")
    facts = {}

    def run(run_id: str, key: str, as_of: str, count: int | None = None) -> None:
        try:
            run_dataset(spark, spec, [key], Run(run_id, as_of, record_count=count), layers)
        except GateError:
            pass
        facts[run_id] = spark.table(spec.table(layers.gold, "fact")).count()

    run("run-1", early, "2024-01-20 06:00:00")
    run("run-2", later, "2024-01-31 06:00:00", count=-1)
    run("run-3", later, "2024-01-31 06:00:00")
    counted = F.create_map(*[F.lit(x) for item in facts.items() for x in item])[F.col("run_id")]
    return spark.table(f"{layers.ops}.dataset_runs").select(
        "run_id", "status", "bronze_rows", "batch_rows",
        F.coalesce(F.col("cast_failures")["low"], F.lit(0)).alias("low_failures"), counted.cast("bigint").alias("facts"),
    )


@query(
    "job_roll_back",
    f"""WITH {PRICES}
  SELECT commodity, symbol, 'daily' AS "interval", strftime(trade_date, '%Y-%m-%d') AS trade_date,
         CASE WHEN year(trade_date) = 1998 AND month(trade_date) = 2 THEN value + 1 ELSE value END AS value,
         CASE WHEN year(trade_date) = 1998 AND month(trade_date) = 2 THEN 'EUR' ELSE unit END AS unit
  FROM prices WHERE trade_date < DATE '1998-03-01'""",
)
def rolled_back_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs of the commodity job over all prices, the last rolled back: the fact is that of the second, with the first descriptions."""
    spec, layers = DATASETS["commodity_prices"], _own_layers(spark, "job_roll_back")
    lines = prices(spark, sf).select(
        "commodity", "symbol", "interval", F.col("trade_date").cast("string").alias("date"), "value", "unit",
        F.lit("alphavantage").alias("source"), F.lit("commodity_prices").alias("dataset"),
        F.lit("/query").alias("request_url"), F.lit(INGESTED).alias("received_at"),
    )
    first = lines.where("date < '1998-03-01'")
    second = lines.where("date >= '1998-02-01' AND date < '1998-03-01'").withColumns(
        {"value": F.col("value") + 1, "unit": F.lit("EUR"), "commodity": F.lit("renamed"), "interval": F.lit("weekly")}
    )
    third = lines.where("date >= '1998-01-20'").withColumns({"value": F.col("value") + 2, "commodity": F.lit("again")})
    for n, batch in enumerate((first, second, third), 1):
        run_dataset(spark, spec, [_land(batch, "land")], Run(f"run-{n}", f"1998-0{n + 3}-01 00:00:00"), layers)
    roll_back(spark, spec, "1998-05-01 00:00:00", layers)
    fact = spark.table(spec.table(layers.gold, "fact"))
    return fact.select("commodity", "symbol", "interval", text("trade_date"), "value", "unit")


# --- catalog, columns, registry, preview ------------------------------------------------------------------


@query(
    "catalog_tables",
    """SELECT 'created' AS step, 0 AS n UNION ALL SELECT 'unregistered', 0
  UNION ALL SELECT 'registered', (SELECT count(*) FROM orders) UNION ALL SELECT 'dropped', 0""",
)
def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """A table is created, its folders are written beside the catalog, registered, and the table is dropped."""
    layers = _own_layers(spark, "catalog_tables")
    name = f"{layers.silver}.orders_by_status"
    columns = {"o_orderkey": "bigint", "o_orderstatus": "string"}
    tables.create_table(spark, name, columns, "o_orderstatus", location=layers.location)
    steps = {"created": spark.table(name).count()}
    path = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
    table(spark, sf, "orders").select(*columns).write.mode("append").partitionBy("o_orderstatus").parquet(path)
    steps["unregistered"] = spark.table(name).count()
    tables.register_partitions(spark, name)
    spark.catalog.refreshTable(name)
    steps["registered"] = spark.table(name).count()
    tables.drop_table(spark, name)
    steps["dropped"] = int(spark.catalog.tableExists(name))
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("step"), F.lit(n).cast("bigint").alias("n")) for k, n in steps.items()]))
    return spark.range(1).select(rows.alias("r")).select("r.*")


@query(
    "required_columns",
    """SELECT 'rows' AS what, count(*) AS n FROM events UNION ALL SELECT 'absent', 1 UNION ALL SELECT 'present', 2""",
)
def column_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Names decide: a column that is NULL throughout is there, one that no line names is absent."""
    path = scratch_path(spark, "required_columns")
    lines = table(spark, sf, "events").select(F.to_json(F.struct("event_id", F.lit(None).cast("string").alias("note")), {"ignoreNullFields": "false"}))
    lines.write.text(path)
    read = scan_bronze(spark, [path], ["event_id", "note", "price"], members=True)
    n, absent = missing_columns(read, ["event_id", "note", "price"], "_members")
    found = {"rows": n, "absent": len(absent), "present": 3 - len(absent)}
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("what"), F.lit(v).cast("bigint").alias("n")) for k, v in found.items()]))
    return spark.range(1).select(rows.alias("r")).select("r.*")


@query(
    "preview",
    """SELECT least(count(*), 5) AS n, true AS subset FROM nation""",
)
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Which rows a preview shows is open; that they are rows of the table is not."""
    nation = table(spark, sf, "nation")
    shown = preview(nation, 5)
    known = shown.join(nation.select(F.col("n_nationkey").alias("k")), F.col("n_nationkey") == F.col("k"), "left")
    return known.agg(F.count(F.lit(1)).alias("n"), F.every(F.col("k").isNotNull()).alias("subset"))
