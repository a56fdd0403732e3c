import json

import pytest

from stratalake.functions.casting import _MAY_BE_NUMBER, cast_or_null, double_or_default, text_to_double, utc_iso
from stratalake.functions.payload import redact_url
from stratalake.operators import flatten
from pyspark.sql import functions as F

from .conftest import rows


def raw(spark, *payloads, **parameters):
    names = list(parameters)
    data = [
        (p if isinstance(p, str) else json.dumps(p), "/u", "2024-01-01T00:00:00+00:00", *parameters.values())
        for p in payloads
    ]
    schema = ", ".join(["payload string, request_url string, received_at string", *[f"{n} string" for n in names]])
    return spark.createDataFrame(data, schema)


BAR = {"1. open": "100", "2. high": "110.5", "3. low": "n/a", "4. close": "105", "5. volume": "1000000"}


def test_date_map(spark):
    good = {"Meta Data": {"x": "y"}, "Time Series (Daily)": {"2024-01-01": BAR, "2024-01-02": BAR}}
    df = flatten.date_map(raw(spark, good, {"Note": "limit"}, "broken", symbol="AAPL"))
    assert rows(df, "symbol", "trade_date", "open", "low", "volume") == [
        ("AAPL", "2024-01-01", 100.0, 0.0, 1000000),
        ("AAPL", "2024-01-02", 100.0, 0.0, 1000000),
    ]
    nulls = flatten.date_map(raw(spark, good, symbol="AAPL"), missing="null")
    assert nulls.where("low IS NULL").count() == 2


def test_series(spark):
    good = {"name": "Crude", "interval": "monthly", "unit": "USD", "data": [{"date": "2024-01-01", "value": "."}, {"date": "2024-02-01", "value": "71.5"}]}
    df = flatten.series(raw(spark, good, {"name": "x", "data": []}, {"Information": "x"}, symbol="WTI"))
    assert rows(df, "commodity", "symbol", "date", "value", "unit") == [
        ("Crude", "WTI", "2024-01-01", 0.0, "USD"),
        ("Crude", "WTI", "2024-02-01", 71.5, "USD"),
    ]


def test_nested_map(spark):
    body = {"values": {"LUR": {"IND": {"2020": 7.9, "2021": None}, "USA": {"2020": 8}}}}
    df = flatten.nested_map(raw(spark, body, {"other": 1}))
    assert rows(df, "indicator", "country", "year", "value") == [
        ("LUR", "IND", 2020, 7.9),
        ("LUR", "IND", 2021, None),
        ("LUR", "USA", 2020, 8.0),
    ]


def test_rate_map(spark):
    ok = {"status": "success", "currency": "USD", "unit": "toz", "metals": {"gold": 2000.5, "silver": 23}, "timestamps": {"metal": "2024-01-01T00:00:00Z"}}
    untimed = {"status": "success", "metals": {"tin": 1}}
    source = raw(spark, ok, untimed, {"status": "failure", "metals": {"gold": 1}}, {"metals": {"gold": 1}})
    assert rows(flatten.rate_map(source), "metal", "rate", "market_time") == [
        ("gold", 2000.5, "2024-01-01T00:00:00Z"),
        ("silver", 23.0, "2024-01-01T00:00:00Z"),
        ("tin", 1.0, None),
    ]
    assert rows(flatten.rate_map_failures(source), "status") == [("failure",), (None,)]


def test_values(spark):
    meta = {"symbol": "XAU/USD", "interval": "1day", "currency_base": "Gold", "currency_quote": "USD", "type": "Commodity"}
    bar = {"open": "1", "high": "2", "low": "0.5", "close": "1.5"}
    body = {"meta": meta, "values": [{"datetime": "2024-01-01", **bar}, {"datetime": "2024-01-02 10:00:00", **bar}]}
    df = flatten.values(raw(spark, body, {"meta": meta, "values": []}))
    assert rows(df, "symbol", "market_time", "close") == [
        ("XAU/USD", "2024-01-01", 1.5),
        ("XAU/USD", "2024-01-02T10:00:00+00:00", 1.5),
    ]


def test_articles(spark):
    body = {"articles": [{"url": "u", "title": "t", "author": None, "source": {"id": None, "name": "n"}, "description": "d", "publishedAt": "p"}]}
    df = flatten.articles(raw(spark, body, {"status": "ok"}))
    assert rows(df, "article_url", "author", "source_news", "source_id", "published_at") == [("u", None, "n", None, "p")]


def test_swings(spark):
    high = {"ticker": "A", "company": "A Ltd", "price": 10, "52_week_high": 12, "52_week_low": 3}
    body = {"NSE_52WeekHighLow": {"high52Week": [high], "low52Week": [high], "other": [high]}, "BSE_52WeekHighLow": {"high52Week": [high]}}
    assert rows(flatten.swings(raw(spark, body)), "swing_type", "swing_price") == [
        ("high52Week", 12.0),
        ("low52Week", 3.0),
        ("other", 3.0),
    ]


def test_risk_premium(spark):
    body = [{"country": "India", "continent": "Asia", "countryRiskPremium": 3.1}, {"country": "Chad", "countryRiskPremium": None, "totalEquityRiskPremium": 9}]
    assert rows(flatten.risk_premium(raw(spark, body)), "country", "country_risk_premium", "total_equity_risk_premium") == [
        ("Chad", 0.0, 9.0),
        ("India", 3.1, 0.0),
    ]
    assert rows(flatten.risk_premium(raw(spark, body), ["India"]), "country") == [("India",)]


def test_performance(spark):
    body = [{"date": "2024-01-01", "industry": "Steel", "exchange": "X", "averageChange": 1.5}, {"date": "2024-01-01", "industry": "Rail", "exchange": "X"}]
    snapshot = flatten.performance(raw(spark, body), "industry", "snapshot", ["Steel"])
    assert rows(snapshot, "industry", "average_change", "dataset") == [("Steel", 1.5, "industry_snapshot")]
    assert flatten.performance(raw(spark, body), "industry", "historical", ["Steel"]).count() == 2
    with pytest.raises(ValueError):
        flatten.performance(raw(spark, body), "stock", "snapshot", [])
    with pytest.raises(ValueError):
        flatten.performance(raw(spark, body), "sector", "live", [])


def test_locations(spark):
    body = [{"city": "", "state": "Goa", "price": "99.5", "change": 0.1, "date": "2024-01-01"}, {"name": "Puri", "price": 98}]
    live = flatten.locations(raw(spark, body, request_dataset="petrol_state_live", location=None))
    assert rows(live, "fuel_type", "location", "price", "date", "dataset") == [
        ("petrol", "Goa", 99.5, None, "petrol_state_live"),
        ("petrol", "Puri", 98.0, None, "petrol_state_live"),
    ]
    past = flatten.locations(raw(spark, body, request_dataset="diesel_city_historical", location="Delhi"))
    assert rows(past, "location_type", "date", "dataset") == [
        ("city", "2024-01-01", "diesel_city_historical_delhi"),
        ("city", None, "diesel_city_historical_delhi"),
    ]


ERRORS = {
    '{"status":"error","message":"m"}': (True, "m"),
    '{"status":"error"}': (True, "API returned error status"),
    '{"status":"error","message":null}': (True, None),
    '{"error":"x"}': (True, "x"),
    '{"error":{"a":1}}': (True, '{"a":1}'),
    '{"error":5}': (False, None),
    '{"code":401,"message":"no"}': (True, "no"),
    '{"code":503}': (True, "API error code 503"),
    '{"code":"401"}': (False, None),
    '{"code":399}': (False, None),
    '[{"status":"error"}]': (False, None),
    "not json": (False, None),
}


def test_soft_errors(spark):
    df = flatten.with_soft_errors(raw(spark, *ERRORS))
    assert {r["payload"]: (r["has_error"], r["error_message"]) for r in df.collect()} == ERRORS


def test_redact(spark):
    urls = {
        "https://a/b?apikey=1&q=2": "https://a/b?apikey=REDACTED&q=2",
        "https://a/b?q=2&API-KEY=1#f": "https://a/b?q=2&API-KEY=REDACTED#f",
        "https://a/b?monkey=1&keyword=2": "https://a/b?monkey=1&keyword=2",
        "https://a/key=1": "https://a/key=1",
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert dict(df.select("u", redact_url("u")).collect()) == urls


def test_casts(spark):
    df = spark.createDataFrame([("12",), ("12.7",), (" 5 ",), ("1e3",), ("x1",), ("",), (None,), ("NaN",)], "t string")
    got = df.select(cast_or_null("t", "bigint").alias("i"), cast_or_null("t", "double").alias("d"), double_or_default("t").alias("z")).collect()
    assert [r["i"] for r in got][:7] == [12, 12, 5, 1000, None, None, None]
    assert [r["d"] for r in got][:7] == [12.0, 12.7, 5.0, 1000.0, None, None, None]
    assert [r["z"] for r in got][:7] == [12.0, 12.7, 5.0, 1000.0, 0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        double_or_default("t", "drop")


def test_utc_iso(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02",), ("2024-13-02 03:04:05",), (None,)], "t string")
    assert [r[0] for r in df.select(utc_iso(F.col("t"))).collect()] == [
        "2024-01-02T03:04:05+00:00", "2024-01-02", "2024-13-02 03:04:05", None,
    ]


def test_one_bad_element_costs_nothing_else(spark):
    """Elements of other kinds are told apart; the rows beside them stay."""
    meta = {"symbol": "X"}
    bodies = {
        "date_map": ({"Time Series (Daily)": {"2024-01-01": BAR, "a": "n/a", "b": [1], "c": None}}, 1, ["not an object"] * 3),
        "series": ({"data": [{"date": "2024-01-01", "value": "1"}, "x", 3, None]}, 1, ["not an object"] * 3),
        "nested_map": ({"values": {"A": {"X": {"2020": 1, "2021": "n/a", "2022": [1], "2023": "2.5", "2024": None}}, "B": 3, "C": {"X": "n/a"}}}, 3, ["not a number"] * 2 + ["not an object"] * 2),
        "rate_map": ({"status": "success", "metals": {"gold": 1, "tin": {"bid": 1}, "lead": "n/a"}}, 1, ["not a number"] * 2),
        "values": ({"meta": meta, "values": [{"datetime": "2024-01-01"}, 5]}, 1, ["not an object"]),
        "articles": ({"articles": [{"url": "u", "source": "plain"}, "ad", []]}, 1, ["not an object"] * 2),
        "swings": ({"NSE_52WeekHighLow": {"high52Week": [{"ticker": "A"}, 1], "note": "closed", "low52Week": [{"ticker": "B"}]}}, 2, ["not a list", "not an object"]),
        "risk_premium": ([{"country": "India"}, "x"], 1, ["not an object"]),
        "locations": ([{"city": "Goa"}, 1.5], 1, ["not an object"]),
    }
    for name, (body, kept, problems) in bodies.items():
        source = raw(spark, body, "{", {"error": "quota"}, {"nothing": 1} if name not in ("risk_premium", "locations") else {"a": 1}, symbol="S", request_dataset="petrol_state_live", location=None)
        assert getattr(flatten, name)(source).count() == kept, name
        found = flatten.rejected(name, source).collect()
        odd = {"rate_map": "status: none", "risk_premium": "not a list", "locations": "not a list"}.get(name, "no data")
        assert sorted(r["problem"] for r in found) == sorted([*problems, "not json", "error: quota", odd]), name
        assert all(r["raw"] and r["path"].startswith("$") for r in found)


def test_empty_lists_are_no_problem(spark):
    source = raw(spark, {"data": []}, {"data": "x"}, {"data": None}, symbol="S")
    assert flatten.series(source).count() == 0
    assert sorted(r["problem"] for r in flatten.rejected("series", source).collect()) == ["not a list", "not a list"]


def test_whole_payloads_reject_errors_only(spark):
    source = raw(spark, [1], {"a": 1}, "5", "{", {"status": "error", "message": "m"})
    made = flatten.FLATTENERS["whole_payload"]("trending")
    assert made.rows(source).count() == 3
    assert sorted(r["problem"] for r in made.rejected(source).collect()) == ["error: m", "not json"]


def test_articles_keep_the_language(spark):
    body = {"articles": [{"url": "u"}]}
    assert rows(flatten.articles(raw(spark, body, language="en"), language=True), "article_url", "language") == [("u", "en")]


def test_long_payloads(spark):
    """Many elements in one response: each carries its own text only."""
    days = {f"{y}-{m:02}-{d:02}": BAR for y in range(2000, 2020) for m in range(1, 13) for d in range(1, 29)}
    source = raw(spark, {"Time Series (Daily)": {**days, "bad": 5}}, symbol="A")
    opened = flatten.FLATTENERS["date_map"]().opened(source)
    held = opened.select(F.sum(sum(F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in opened.columns)).alias("n")).first()["n"]
    assert opened.count() == len(days) + 1 and held < 2 * source.select(F.length("payload")).first()[0]
    assert flatten.date_map(source).count() == len(days)
    assert [r["path"] for r in flatten.rejected("date_map", source).collect()] == ["$.series.bad"]
    points = raw(spark, {"name": "n", "data": [{"date": str(i), "value": i} for i in range(100_000)] + [7]}, symbol="A")
    assert flatten.series(points).agg(F.sum("value")).first()[0] == sum(range(100_000))
    assert [(r["path"], r["raw"]) for r in flatten.rejected("series", points).collect()] == [("$.data[100000]", "7")]


def test_members_named_twice(spark):
    """The last counts, as in most readers of JSON."""
    source = raw(spark, '{"data":[{"date":"a","value":1}],"data":[{"date":"b","date":"c","value":2}]}', symbol="S")
    assert rows(flatten.series(source), "date", "value") == [("c", 2.0)]


def test_long_allow_lists(spark):
    """A list of any length, with names twice, is a semi join: no literals in the plan, no row twice; a table does as well."""
    body = [{"country": c, "countryRiskPremium": 1} for c in ("India", "Chad", "Peru", None)]
    names = [f"Country {n}" for n in range(50_000)] + ["India", "Peru", "India"]
    found = flatten.risk_premium(raw(spark, body), names)
    assert rows(found, "country") == [("India",), ("Peru",)]
    assert len(found._jdf.queryExecution().executedPlan().toString()) < 50_000
    table = spark.createDataFrame([(n, 1) for n in names], "name string, country int")
    assert rows(flatten.risk_premium(raw(spark, body), table), "country") == [("India",), ("Peru",)]
    sectors = [{"sector": "Energy", "averageChange": 1}, {"sector": "Steel"}]
    assert rows(flatten.performance(raw(spark, sectors), "sector", "snapshot", ["Energy", *names]), "sector") == [("Energy",)]
    assert flatten.performance(raw(spark, sectors), "sector", "snapshot", []).count() == 0


def test_text_that_holds_digits_is_told_from_numbers_before_the_cast(spark):
    """A failed conversion costs far more than a match; whatever converts still does."""
    texts = ["1", " -1.5e+3\t", "2d", ".5", "5.", "+NaN", "-Infinity", " inf ", "0x1.8p3", "n/a", "1,2", "2024-01-01", '{"bid":1}', "1 2", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert df.where(~text_to_double("v").eqNullSafe(F.col("v").try_cast("double"))).count() == 0
    tried = {r[0] for r in df.where(F.col("v").rlike(_MAY_BE_NUMBER)).collect()}
    assert tried == {"1", " -1.5e+3\t", "2d", ".5", "5.", "+NaN", "-Infinity", " inf ", "0x1.8p3"}
