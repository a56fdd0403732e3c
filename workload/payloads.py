"""Raw payloads, written from the test tables as JSON text, and flattened again.

The SQL side computes the expected rows from the tables, without JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.casting import utc_iso
from stratalake.functions.payload import payload_value, redact_url
from stratalake.operators import flatten

from .derived import BARS, INDICATORS, PRICES, bars, indicators, prices
from .registry import query, table

RECEIVED = "2024-02-01T00:00:00+00:00"
_NOTE = f"'{RECEIVED}' AS received_at"


def _raw(df: DataFrame, payload: Column, url: Column, *parameters: str) -> DataFrame:
    return df.select(
        *parameters,
        payload.alias("payload"),
        url.alias("request_url"),
        F.lit(RECEIVED).alias("received_at"),
    )


def _spoiled(payload: Column, after: str, extra: str) -> Column:
    """The payload with more elements, of other kinds than the format has, behind a place in it."""
    place = F.instr(payload, after) + (len(after) - 1)
    return F.concat(F.substring(payload, F.lit(1), place), F.lit(extra), F.substr(payload, place + 1))


def _with_failures(spark: SparkSession, sf: str, raw: DataFrame) -> DataFrame:
    """And two responses per region without data: a reported error, and a text that is no JSON."""
    body = F.explode(F.array(F.lit('{"error":"quota"}'), F.lit('{"cut": [1, ')))
    failed = table(spark, sf, "region").select(
        body.alias("payload"), F.concat(F.lit("/failed?"), F.col("r_name")).alias("request_url"), F.lit(RECEIVED).alias("received_at")
    )
    return raw.unionByName(failed, allowMissingColumns=True)


def _url(path: str, *parts: str) -> Column:
    return F.concat(F.lit(path), F.concat_ws("-", *[F.col(p).cast("string") for p in parts]))


# --- date-keyed map ------------------------------------------------------------------------


@query(
    "flatten_date_map",
    f"""WITH {BARS} SELECT symbol, strftime(trade_date, '%Y-%m-%d') AS trade_date, open, high,
  CASE WHEN volume = 1 THEN 0.0 ELSE low END AS low, close, volume, 'alphavantage' AS source,
  'time_series_daily' AS dataset, '/query?' || symbol || '-' || strftime(trade_date, '%Y-%m') AS request_url, {_NOTE}
  FROM bars""",
)
def date_map(spark: SparkSession, sf: str) -> DataFrame:
    """One response per symbol and month (at most 31 bars); a price that is no number becomes 0."""
    return flatten.date_map(_date_map_raw(spark, sf))


def _date_map_raw(spark: SparkSession, sf: str) -> DataFrame:
    entry = F.struct(
        F.col("trade_date").cast("string"),
        F.struct(
            F.col("open").cast("string").alias("1. open"),
            F.col("high").cast("string").alias("2. high"),
            F.when(F.col("volume") == 1, "n/a").otherwise(F.col("low").cast("string")).alias("3. low"),
            F.col("close").cast("string").alias("4. close"),
            F.col("volume").cast("string").alias("5. volume"),
        ),
    )
    monthly = (
        bars(spark, sf)
        .groupBy("symbol", F.date_format("trade_date", "yyyy-MM").alias("month"))
        .agg(F.map_from_entries(F.collect_list(entry)).alias("days"))
    )
    head = F.create_map(F.lit("2. Symbol"), F.col("symbol"))
    payload = F.to_json(F.struct(head.alias("Meta Data"), F.col("days").alias("Time Series (Daily)")))
    payload = _spoiled(payload, '"Time Series (Daily)":{', '"holiday":"closed","early":[1],')
    return _with_failures(spark, sf, _raw(monthly, payload, _url("/query?", "symbol", "month"), "symbol"))


# --- list under a head -----------------------------------------------------------------------


@query(
    "flatten_series",
    f"""WITH {PRICES} SELECT commodity, symbol, "interval", strftime(trade_date, '%Y-%m-%d') AS date,
  CASE WHEN value > 90000 THEN 0.0 ELSE value END AS value, 'USD' AS unit, 'alphavantage' AS source,
  'commodity_prices' AS dataset, '/query?' || symbol || '-' || CAST(year(trade_date) AS VARCHAR) AS request_url, {_NOTE}
  FROM prices""",
)
def series(spark: SparkSession, sf: str) -> DataFrame:
    """One response per symbol and year (at most 366 points); "." stands for a missing value."""
    return flatten.series(_series_raw(spark, sf))


def _series_raw(spark: SparkSession, sf: str) -> DataFrame:
    point = F.struct(
        F.col("trade_date").cast("string").alias("date"),
        F.when(F.col("value") > 90000, ".").otherwise(F.col("value").cast("string")).alias("value"),
    )
    yearly = (
        prices(spark, sf)
        .groupBy("commodity", "symbol", F.year("trade_date").alias("year"))
        .agg(F.collect_list(point).alias("data"))
    )
    payload = F.to_json(
        F.struct(
            F.col("commodity").alias("name"),
            F.lit("daily").alias("interval"),
            F.lit("USD").alias("unit"),
            F.col("data"),
        )
    )
    payload = _spoiled(payload, '"data":[', '"none",7,')
    return _with_failures(spark, sf, _raw(yearly, payload, _url("/query?", "symbol", "year"), "symbol"))


# --- nested maps -------------------------------------------------------------------------------


@query(
    "flatten_nested_map",
    f"""WITH {INDICATORS} SELECT indicator, country, CAST(year AS BIGINT) AS year, value, 'imf' AS source,
  'indicators' AS dataset, '/api/' || country AS request_url, {_NOTE} FROM ind""",
)
def nested_map(spark: SparkSession, sf: str) -> DataFrame:
    """One response per country: its indicators (five) by year."""
    flat = flatten.nested_map(_nested_map_raw(spark, sf))
    return flat.withColumn("year", F.col("year").cast("bigint"))


def _nested_map_raw(spark: SparkSession, sf: str) -> DataFrame:
    years = (
        indicators(spark, sf)
        .groupBy("country", "indicator")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct(F.col("year").cast("string"), F.col("value")))
            ).alias("years")
        )
    )
    whole_country = years.groupBy("country").agg(
        F.map_from_entries(
            F.collect_list(F.struct("indicator", F.create_map(F.col("country"), F.col("years"))))
        ).alias("values")
    )
    payload = F.to_json(F.struct("values"))
    payload = _spoiled(payload, '"values":{', '"GONE":5,"HALF":{"X":"n/a"},"CELL":{"X":{"2000":"n/a"}},')
    return _with_failures(spark, sf, _raw(whole_country, payload, _url("/api/", "country")))


# --- map of rates ----------------------------------------------------------------------------------

_METALS = {
    "gold": "l_quantity",
    "silver": "l_extendedprice",
    "platinum": "l_discount",
    "palladium": "l_tax",
}


@query(
    "flatten_rate_map",
    " UNION ALL ".join(
        f"""SELECT '{metal}' AS metal, {column} AS rate, 'USD' AS currency, 'toz' AS unit,
  strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00Z' AS market_time, 'metals_dev' AS source, 'spot_prices' AS dataset,
  '/latest/' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS request_url, {_NOTE}
  FROM lineitem WHERE l_returnflag <> 'R'"""
        for metal, column in _METALS.items()
    ),
)
def rate_map(spark: SparkSession, sf: str) -> DataFrame:
    """Returned lines stand for failed responses; only successful ones give rows."""
    return flatten.rate_map(_rate_map_raw(spark, sf))


def _rate_map_raw(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("day", F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    payload = F.to_json(
        F.struct(
            F.when(F.col("l_returnflag") == "R", "failure").otherwise("success").alias("status"),
            F.lit("USD").alias("currency"),
            F.lit("toz").alias("unit"),
            F.struct(*[F.col(c).alias(m) for m, c in _METALS.items()]).alias("metals"),
            F.struct(F.col("day").alias("metal")).alias("timestamps"),
        )
    )
    payload = _spoiled(payload, '"metals":{', '"tin":{"bid":1},')
    return _with_failures(spark, sf, _raw(lines, payload, _url("/latest/", "l_orderkey", "l_linenumber")))


# --- bars under meta -------------------------------------------------------------------------------


@query(
    "flatten_values",
    f"""WITH {BARS} SELECT symbol, '1day' AS "interval", 'US Dollar' AS currency_base, 'Rupee' AS currency_quote,
  'Physical Currency' AS type, strftime(trade_date, '%Y-%m-%d')
    || CASE WHEN volume > 1 THEN 'T00:00:00+00:00' ELSE '' END AS market_time, open, high, low, close,
  'twelvedata' AS source, 'exchange_rates' AS dataset,
  '/time_series?' || symbol || '-' || strftime(trade_date, '%Y-%m') AS request_url, {_NOTE} FROM bars""",
)
def values(spark: SparkSession, sf: str) -> DataFrame:
    """Times with a time of day become ISO UTC text, plain dates stay."""
    return flatten.values(_values_raw(spark, sf))


def _values_raw(spark: SparkSession, sf: str) -> DataFrame:
    bar = F.struct(
        F.when(F.col("volume") > 1, F.concat(F.col("trade_date").cast("string"), F.lit(" 00:00:00")))
        .otherwise(F.col("trade_date").cast("string"))
        .alias("datetime"),
        *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close")],
    )
    monthly = (
        bars(spark, sf)
        .groupBy("symbol", F.date_format("trade_date", "yyyy-MM").alias("month"))
        .agg(F.collect_list(bar).alias("values"))
    )
    meta = F.struct(
        "symbol",
        F.lit("1day").alias("interval"),
        F.lit("US Dollar").alias("currency_base"),
        F.lit("Rupee").alias("currency_quote"),
        F.lit("Physical Currency").alias("type"),
    )
    payload = F.to_json(F.struct(meta.alias("meta"), F.col("values")))
    payload = _spoiled(payload, '"values":[', 'null,')
    return _with_failures(spark, sf, _raw(monthly, payload, _url("/time_series?", "symbol", "month")))


# --- articles --------------------------------------------------------------------------------------


@query(
    "flatten_articles",
    f"""SELECT 'https://news.example.com/' || CAST(doc_id AS VARCHAR) AS article_url,
  source || ' ' || CAST(n_chars AS VARCHAR) AS title, CASE WHEN lang <> 'de' THEN 'Desk ' || lang END AS author,
  source AS source_news, CASE WHEN lang = 'en' THEN lower(source) END AS source_id, text AS description,
  '2024-01-15T08:30:00Z' AS published_at, 'newsapi' AS source_api, 'everything' AS dataset,
  '/v2/everything?' || CAST(doc_id AS VARCHAR) AS request_url, {_NOTE} FROM documents""",
)
def articles(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.articles(_articles_raw(spark, sf))


def _articles_raw(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    article = F.struct(
        _url("https://news.example.com/", "doc_id").alias("url"),
        F.concat_ws(" ", "source", F.col("n_chars").cast("string")).alias("title"),
        F.when(F.col("lang") != "de", F.concat(F.lit("Desk "), F.col("lang"))).alias("author"),
        F.struct(
            F.when(F.col("lang") == "en", F.lower("source")).alias("id"), F.col("source").alias("name")
        ).alias("source"),
        F.col("text").alias("description"),
        F.lit("2024-01-15T08:30:00Z").alias("publishedAt"),
    )
    payload = F.to_json(F.struct(F.lit("ok").alias("status"), F.array(article).alias("articles")))
    payload = _spoiled(payload, '"articles":[', '"advert",')
    asked = docs.withColumn("language", F.col("lang"))
    return _with_failures(spark, sf, _raw(asked, payload, _url("/v2/everything?", "doc_id"), "language"))


# --- swings ------------------------------------------------------------------------------------------


@query(
    "flatten_swings",
    " UNION ALL ".join(
        f"""SELECT c_name AS ticker, c_mktsegment AS company, c_acctbal AS price, '{swing}' AS swing_type,
  {price} AS swing_price, 'indian_stock_api' AS source, '52_week_high_low_data' AS dataset,
  '/hld?' || CAST(c_custkey AS VARCHAR) AS request_url, {_NOTE} FROM customer"""
        for swing, price in (("high52Week", "c_acctbal * 2"), ("low52Week", "c_acctbal / 2"))
    ),
)
def swings(spark: SparkSession, sf: str) -> DataFrame:
    """Each response has a high and a low list; the other exchange is ignored."""
    return flatten.swings(_swings_raw(spark, sf))


def _swings_raw(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    base = [F.col("c_name").alias("ticker"), F.col("c_mktsegment").alias("company"), F.col("c_acctbal").alias("price")]
    high = F.struct(*base, (F.col("c_acctbal") * 2).alias("52_week_high"))
    low = F.struct(*base, (F.col("c_acctbal") / 2).alias("52_week_low"))
    lists = F.struct(F.array(high).alias("high52Week"), F.array(low).alias("low52Week"))
    payload = F.to_json(F.struct(lists.alias("BSE_52WeekHighLow"), lists.alias("NSE_52WeekHighLow")))
    payload = _spoiled(payload, '"NSE_52WeekHighLow":{', '"note":"half day",')
    return _with_failures(spark, sf, _raw(customers, payload, _url("/hld?", "c_custkey")))


# --- performance, premiums, places ----------------------------------------------------------------------

_SECTORS = ("BUILDING", "MACHINERY")


def _performance_raw(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    item = F.struct(
        F.lit("2024-01-31").alias("date"),
        F.col("c_mktsegment").alias("sector"),
        F.lit("NASDAQ").alias("exchange"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("averageChange"),
    )
    payload = _spoiled(F.to_json(F.array(item)), "[", '"page 1",')
    return _with_failures(spark, sf, _raw(customers, payload, _url("/performance?", "c_custkey")))


def _performance(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    return flatten.performance(_performance_raw(spark, sf), "sector", mode, _SECTORS)


def _performance_sql(mode: str, where: str) -> str:
    return f"""SELECT '2024-01-31' AS date, c_mktsegment AS sector, 'NASDAQ' AS exchange,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE 0.0 END AS average_change, 'financial_modeling_prep' AS source,
  'sector_{mode}' AS dataset, '/performance?' || CAST(c_custkey AS VARCHAR) AS request_url, {_NOTE}
  FROM customer {where}"""


@query(
    "flatten_performance",
    f"{_performance_sql('snapshot', f'WHERE c_mktsegment IN {_SECTORS}')} UNION ALL {_performance_sql('historical', '')}",
)
def performance(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots are cut to the requested sectors, histories are not; a missing change is 0."""
    return _performance(spark, sf, "snapshot").unionByName(_performance(spark, sf, "historical"))


_COUNTRIES = ("NATION_2", "NATION_5", "NATION_11")


@query(
    "allow_list",
    f"""SELECT n_name AS country, r_name AS continent, s_acctbal AS country_risk_premium,
  0.0::DOUBLE AS total_equity_risk_premium, 'financial_modeling_prep' AS source, 'market_risk_premium' AS dataset,
  '/risk?' || CAST(s_suppkey AS VARCHAR) AS request_url, {_NOTE}
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE n_name IN {_COUNTRIES}""",
)
def risk_premium(spark: SparkSession, sf: str) -> DataFrame:
    """Premiums of the allowed countries; a missing premium is 0."""
    return flatten.risk_premium(_risk_premium_raw(spark, sf), _COUNTRIES)


def _risk_premium_raw(spark: SparkSession, sf: str) -> DataFrame:
    supplier, nation, region = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    rows = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    item = F.struct(
        F.col("n_name").alias("country"),
        F.col("r_name").alias("continent"),
        F.col("s_acctbal").alias("countryRiskPremium"),
    )
    payload = _spoiled(F.to_json(F.array(item)), "[", "[],")
    return _with_failures(spark, sf, _raw(rows, payload, _url("/risk?", "s_suppkey")))


@query(
    "flatten_locations",
    f"""SELECT CASE WHEN s_acctbal < 5000 THEN 'diesel' ELSE 'petrol' END AS fuel_type,
  CASE WHEN s_acctbal < 5000 THEN 'city' ELSE 'state' END AS location_type, s_acctbal AS price, 0.5::DOUBLE AS change,
  CASE WHEN s_acctbal < 0 THEN 'City of ' || s_name WHEN s_acctbal < 7000 THEN 'State of ' || s_name ELSE s_name END AS location,
  CASE WHEN s_acctbal < 5000 THEN '2024-01-31' END AS date, 'indian_api' AS source,
  CASE WHEN s_acctbal < 5000 THEN 'diesel_city_historical_' || lower(s_name) ELSE 'petrol_state_live' END AS dataset,
  '/fuel?' || CAST(s_suppkey AS VARCHAR) AS request_url, {_NOTE} FROM supplier""",
)
def locations(spark: SparkSession, sf: str) -> DataFrame:
    """Places come from city, state or name, whichever is first not empty."""
    return flatten.locations(_locations_raw(spark, sf))


def _locations_raw(spark: SparkSession, sf: str) -> DataFrame:
    low = F.col("s_acctbal") < 5000
    suppliers = (
        table(spark, sf, "supplier")
        .withColumn("request_dataset", F.when(low, "diesel_city_historical").otherwise("petrol_state_live"))
        .withColumn("location", F.when(low, F.col("s_name")))
    )
    item = F.struct(
        F.when(F.col("s_acctbal") < 0, F.concat(F.lit("City of "), F.col("s_name"))).otherwise("").alias("city"),
        F.when(F.col("s_acctbal") < 7000, F.concat(F.lit("State of "), F.col("s_name"))).alias("state"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("price"),
        F.lit("0.5").alias("change"),
        F.lit("2024-01-31").alias("date"),
    )
    payload = _spoiled(F.to_json(F.array(item)), "[", "99.5,")
    return _with_failures(spark, sf, _raw(suppliers, payload, _url("/fuel?", "s_suppkey"), "request_dataset", "location"))


# --- what no row was made of ----------------------------------------------------------------------------------

_MONTHLY = "(SELECT DISTINCT symbol, strftime(trade_date, '%Y-%m') FROM bars)"
_YEARLY = "(SELECT DISTINCT symbol, year(trade_date) FROM prices)"
# flattener, options, its responses, and how many elements of each kind a response has too much
_REJECTING = {
    "date_map": ({}, _date_map_raw, _MONTHLY, {"not an object": 2}),
    "series": ({}, _series_raw, _YEARLY, {"not an object": 2}),
    "nested_map": ({}, _nested_map_raw, "(SELECT DISTINCT country FROM ind)", {"not an object": 2, "not a number": 1}),
    "rate_map": ({}, _rate_map_raw, "lineitem WHERE l_returnflag <> 'R'", {"not a number": 1}),
    "values": ({}, _values_raw, _MONTHLY, {"not an object": 1}),
    "articles": ({}, _articles_raw, "documents", {"not an object": 1}),
    "swings": ({}, _swings_raw, "customer", {"not a list": 1}),
    "performance": ({"level": "sector", "mode": "historical"}, _performance_raw, "customer", {"not an object": 1}),
    "risk_premium": ({}, _risk_premium_raw, "supplier", {"not an object": 1}),
    "locations": ({}, _locations_raw, "supplier", {"not an object": 1}),
}


def _rejected_sql() -> str:
    parts = ["SELECT 'rate_map' AS flattener, 'status: failure' AS problem, count(*) AS n FROM lineitem WHERE l_returnflag = 'R'"]
    for name, (_, _, responses, extra) in _REJECTING.items():
        parts += [f"SELECT '{name}', '{problem}', {times} * count(*) FROM {responses}" for problem, times in extra.items()]
        parts += [f"SELECT '{name}', '{problem}', count(*) FROM region" for problem in ("error: quota", "not json")]
    return f"WITH {BARS}, {PRICES}, {INDICATORS} " + " UNION ALL ".join(parts)


@query("flatten_quarantine", _rejected_sql())
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Every element and response that the flatteners left out, counted by the reason."""
    found = None
    for name, (options, raw, _, _) in _REJECTING.items():
        one = flatten.rejected(name, raw(spark, sf), **options).select(F.lit(name).alias("flattener"), "problem")
        found = one if found is None else found.unionByName(one)
    return found.groupBy("flattener", "problem").agg(F.count(F.lit(1)).alias("n"))


# --- whole payloads and text helpers -----------------------------------------------------------------------


@query(
    "payload_extract",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, props AS data, 'trending' AS dataset,
  json_extract(props, '$.k.deep') IS NULL AS deep_missing FROM events""",
)
def payload_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads stay whole; typed members are read on demand, absent ones are NULL."""
    events = table(spark, sf, "events")
    raw = _raw(events, F.col("props"), F.lit("/trending"), "event_id")
    kept = flatten.whole_payload(raw, "trending", ["event_id"])
    return kept.select(
        "event_id",
        payload_value(F.col("data"), "$.k", "bigint").alias("k"),
        "data",
        "dataset",
        payload_value(F.col("data"), "$.k.deep", "string").isNull().alias("deep_missing"),
    )


@query(
    "soft_errors",
    """SELECT event_id,
  event_type IN ('error', 'click') OR (event_type = 'view' AND CAST(json_extract(props, '$.k') AS INT) >= 50) AS has_error,
  CASE event_type WHEN 'error' THEN 'quota of ' || CAST(user_id AS VARCHAR)
       WHEN 'click' THEN '{"user":' || CAST(user_id AS VARCHAR) || '}'
       WHEN 'view' THEN CASE WHEN CAST(json_extract(props, '$.k') AS INT) >= 50
            THEN 'API error code ' || CAST(350 + CAST(json_extract(props, '$.k') AS INT) AS VARCHAR) END END AS error_message
  FROM events""",
)
def soft_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Bodies of every kind: error status, error object, numeric code, code as text, list, healthy."""
    events = table(spark, sf, "events")
    user = F.col("user_id").cast("string")
    code = (F.get_json_object("props", "$.k").cast("int") + 350).cast("string")
    payload = (
        F.when(F.col("event_type") == "error", F.concat(F.lit('{"status":"error","message":"quota of '), user, F.lit('"}')))
        .when(F.col("event_type") == "click", F.concat(F.lit('{"error":{"user":'), user, F.lit("}}")))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"code":'), code, F.lit("}")))
        .when(F.col("event_type") == "signup", F.concat(F.lit('{"code":"'), code, F.lit('","error":404}')))
        .otherwise(F.concat(F.lit('[{"status":"error"},'), F.col("props"), F.lit("]")))
    )
    raw = _raw(events, payload, F.lit("/status"), "event_id")
    return flatten.with_soft_errors(raw).select("event_id", "has_error", "error_message")


@query(
    "redact_urls",
    r"""WITH u AS (SELECT page_id, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END
    || 'ApiKey=s' || CAST(page_id AS VARCHAR) || '&q=key&monkey=1&token=t' || CAST(page_id AS VARCHAR) || '#end' AS url FROM pages)
  SELECT page_id, regexp_replace(url, '([?&](?:apikey|api_key|api-key|token|key|access_token|password)=)[^&#]*',
                                 '\1REDACTED', 'gi') AS request_url FROM u""",
)
def redact_urls(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    page = F.col("page_id").cast("string")
    url = F.concat(
        F.col("url"),
        F.when(F.col("url").contains("?"), "&").otherwise("?"),
        F.lit("ApiKey=s"), page, F.lit("&q=key&monkey=1&token=t"), page, F.lit("#end"),
    )
    return pages.select("page_id", redact_url(url).alias("request_url"))


@query(
    "utc_normalize",
    """SELECT event_id, CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%d')
       WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
       WHEN 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS market_time FROM events""",
)
def utc_normalize(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    told = (
        F.when(kind == "view", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == "error", F.lit(None))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    return table(spark, sf, "events").select("event_id", utc_iso(told).alias("market_time"))
