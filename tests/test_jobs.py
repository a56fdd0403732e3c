import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from stratalake.operators.quality import GateError
from stratalake.operators.rolling import RollingSpec, add_rolling
from stratalake.plans import registry
from stratalake.plans.ingest import ingest
from stratalake.plans.jobs import Run, _staged_bronze, rebuild_gold, roll_back, run_dataset, run_manifest
from stratalake.plans.registry import ALL_DATASETS, DATASETS, RegistryError, find, load
from stratalake.session import Scratch
from stratalake.sources.bronze import scan_bronze, write_raw_zone
from stratalake.streaming.landing import drain_landing

from .conftest import rows

META = {"source": "s", "dataset": "d", "request_url": "/u", "received_at": "2024-01-01T00:00:00+00:00"}


def land(tmp_path, name, *records, ingested="2024-02-01T00:00:00+00:00"):
    path = tmp_path / f"{name}.jsonl"
    path.write_text("".join(json.dumps({**META, "ingested_at": ingested, **r}) + "\n" for r in records))
    return str(path)


def bar(symbol, day, close, **more):
    return {"symbol": symbol, "trade_date": day, "open": 1, "high": 2.5, "low": 1, "close": close, "volume": 10, **more}


def days(n, start=1):
    return [f"2024-01-{d:02d}" for d in range(start, start + n)]


def test_market_job(spark, layers, tmp_path):
    spec = DATASETS["market_daily"]
    first = [bar("A", d, i + 1) for i, d in enumerate(days(28))] + [bar("B", "2024-01-03", 7)]
    run_dataset(spark, spec, [land(tmp_path, "1", *first)], Run("r1", "2024-02-01 00:00:00", record_count=29), layers)
    silver, fact, metrics = (spec.table(db, s) for db, s in ((layers.silver, "clean"), (layers.gold, "fact"), (layers.gold, "metrics")))
    assert spark.table(silver).count() == spark.table(fact).count() == spark.table(metrics).count() == 29

    change = [bar("A", "2024-01-27", 99.5), bar("A", "2024-01-28", 28), bar("C", "2024-01-29", 3)]
    second = land(tmp_path, "2", *change, ingested="2024-02-02T00:00:00+00:00")
    run_dataset(spark, spec, [second], Run("r2", "2024-02-02 00:00:00"), layers)
    versions = spark.table(silver).where("symbol = 'A' AND trade_date = '2024-01-27'")
    assert rows(versions, "close", "is_current") == [(27.0, False), (99.5, True)]
    assert spark.table(silver).count() == 31
    assert spark.table(fact).count() == 30
    full = add_rolling(spark.table(fact), RollingSpec())
    shown = ["symbol", "trade_date", "close", "daily_return", "ma_5_close", "ma_20_close", "volatility_20"]
    assert rows(spark.table(metrics), *shown) == rows(full, *shown)

    before = rows(spark.table(silver))
    run_dataset(spark, spec, [second], Run("r3", "2024-02-03 00:00:00"), layers)
    assert rows(spark.table(silver)) == before
    runs = spark.table(f"{layers.ops}.dataset_runs")
    assert rows(runs, "run_id", "bronze_rows", "batch_rows") == [("r1", 29, 29), ("r2", 3, 3), ("r3", 3, 3)]


def test_roll_back(spark, layers, tmp_path):
    spec = DATASETS["market_daily"]
    silver, fact = spec.table(layers.silver, "clean"), spec.table(layers.gold, "fact")
    run_dataset(spark, spec, [land(tmp_path, "1", bar("A", "2024-01-01", 1), bar("A", "2024-01-02", 2))], Run("r1", "2024-02-01"), layers)
    metrics = spec.table(layers.gold, "metrics")
    shown = ["symbol", "trade_date", "close", "daily_return", "ma_5_close"]
    before, facts, figures = rows(spark.table(silver)), rows(spark.table(fact), *spec.fact), rows(spark.table(metrics), *shown)
    run_dataset(spark, spec, [land(tmp_path, "2", bar("A", "2024-01-02", 9), bar("B", "2024-01-05", 1))], Run("r2", "2024-02-02"), layers)
    assert rows(spark.table(silver)) != before
    roll_back(spark, spec, "2024-02-01", layers)
    assert rows(spark.table(silver)) == before
    assert rows(spark.table(fact), *spec.fact) == facts
    assert rows(spark.table(metrics), *shown) == figures


def test_gates_stop_before_publishing(spark, layers, tmp_path):
    spec = DATASETS["market_daily"]
    run_dataset(spark, spec, [land(tmp_path, "ok", bar("A", "2024-01-01", 1))], Run("r1", "2024-02-01"), layers)
    silver = spec.table(layers.silver, "clean")
    before = rows(spark.table(silver))

    def refused(match, *records, **run):
        with pytest.raises(GateError, match=match):
            run_dataset(spark, spec, [land(tmp_path, "bad", *records)], Run("r2", "2024-02-02", **run), layers)
        assert rows(spark.table(silver)) == before

    refused("announced 5", bar("A", "2024-01-01", 2), record_count=5)
    refused("missing columns.*volume", {k: v for k, v in bar("A", "2024-01-01", 2).items() if k != "volume"})
    refused("trade_date_present", bar("A", "2024-01-01", 2), bar("A", "no date", 2))
    empty = tmp_path / "empty.jsonl"
    empty.write_text("")
    with pytest.raises(GateError, match="no records"):
        run_dataset(spark, spec, [str(empty)], Run("r2", "2024-02-02"), layers)


def test_two_versions_in_one_batch(spark, layers, tmp_path):
    spec = DATASETS["market_daily"]
    old = bar("A", "2024-01-01", 1, ingested_at="2024-01-31T00:00:00+00:00")
    run_dataset(spark, spec, [land(tmp_path, "1", old, bar("A", "2024-01-01", 2))], Run("r1", "2024-02-01"), layers)
    assert rows(spark.table(spec.table(layers.silver, "clean")), "close") == [(2.0,)]


def test_commodity_job_keeps_first_description(spark, layers, tmp_path):
    spec = DATASETS["commodity_prices"]

    def point(name, interval, value):
        return {"commodity": name, "symbol": "WTI", "interval": interval, "date": "2024-01-01", "value": value, "unit": "USD"}

    run_dataset(spark, spec, [land(tmp_path, "1", point("Crude", "daily", 70))], Run("r1", "2024-02-01"), layers)
    run_dataset(spark, spec, [land(tmp_path, "2", point("Oil", "weekly", 71))], Run("r2", "2024-02-02"), layers)
    fact = spark.table(spec.table(layers.gold, "fact"))
    assert rows(fact, "commodity", "interval", "value") == [("Crude", "daily", 71.0)]


def test_macro_job(spark, layers, tmp_path):
    spec = DATASETS["macro_indicators"]

    def cell(indicator, country, year, value):
        return {"indicator": indicator, "country": country, "year": year, "value": value}

    one = land(tmp_path, "1", cell("LUR", "IND", 2020, 4), cell("LUR", "USA", 2020, 8), cell("BCA_NGDPD", "IND", 2019, 1))
    with open(one, "a") as f:
        f.write('{"indicator": "LUR", \n')  # set aside, not fatal
    run_dataset(spark, spec, [one], Run("r1", "2024-02-01"), layers)
    run_dataset(spark, spec, [land(tmp_path, "2", cell("LUR", "USA", 2020, 2))], Run("r2", "2024-02-02"), layers)
    assert rows(spark.table(spec.table(layers.gold, "fact")), "country", "year", "value") == [
        ("IND", 2019, 1.0), ("IND", 2020, 4.0), ("USA", 2020, 2.0),
    ]
    scores = spark.table(spec.table(layers.gold, "scores"))
    assert rows(scores, "country", "year", "macro_resilience_score") == [("IND", 2019, 50.0), ("IND", 2020, 70.0), ("USA", 2020, 30.0)]
    assert spark.table(spec.table(layers.gold, "tvi")).count() == 3
    tvi = spec.table(layers.gold, "tvi")
    found = rows(spark.table(tvi), "country", "year", "tvi_score")
    rebuild_gold(spark, spec, "2024-02-03", layers)
    assert rows(spark.table(tvi), "country", "year", "tvi_score") == found
    assert rows(spark.table(f"{layers.ops}.quarantine"), "run_id", "line") == [("r1", '{"indicator": "LUR", ')]


def test_spot_job_has_no_duplicates(spark, layers, tmp_path):
    spec = DATASETS["spot_prices"]

    def rate(metal, at, value):
        return {"metal": metal, "rate": value, "currency": "USD", "unit": "toz", "market_time": at}

    key = land(tmp_path, "1", rate("gold", "2024-01-31T23:00:00Z", 1), rate("gold", "2024-02-01T01:00:00Z", 2))
    run_dataset(spark, spec, [key], Run("r1", "2024-02-01"), layers)
    run_dataset(spark, spec, [key], Run("r2", "2024-02-02"), layers)
    newer = land(tmp_path, "2", rate("gold", "2024-02-01T01:00:00Z", 3), ingested="2024-02-05T00:00:00+00:00")
    run_dataset(spark, spec, [newer], Run("r3", "2024-02-05"), layers)
    for name in (spec.table(layers.silver, "clean"), spec.table(layers.gold, "fact")):
        assert rows(spark.table(name), "year_month", "rate") == [("2024-01", 1.0), ("2024-02", 3.0)]


def test_landing_reads_each_object_once(spark, layers, tmp_path):
    spec = DATASETS["exchange_rates"]
    zone = tmp_path / "zone"
    zone.mkdir()

    def quote(at, close):
        return {"symbol": "USD/INR", "interval": "1day", "currency_base": "USD", "currency_quote": "INR", "type": "x",
                "market_time": at, "open": 1, "high": 1, "low": 1, "close": close}

    def drain(as_of):
        drain_landing(spark, spec, str(zone), str(tmp_path / "cp"), layers, as_of).awaitTermination()

    land(zone, "1", quote("2024-01-01T00:00:00", 80), quote("2024-01-02T00:00:00", 81))
    drain("2024-02-01")
    land(zone, "2", quote("2024-01-02T00:00:00", 82), ingested="2024-02-02T00:00:00+00:00")
    drain("2024-02-02")
    drain("2024-02-03")  # nothing new
    assert rows(spark.table(spec.table(layers.gold, "fact")), F.col("market_time").cast("date").cast("string"), "close") == [
        ("2024-01-01", 80.0), ("2024-01-02", 82.0),
    ]
    assert spark.table(f"{layers.ops}.dataset_runs").count() == 2


def test_landing_from_a_raw_zone(spark, layers, tmp_path):
    spec = DATASETS["macro_indicators"]
    base = str(tmp_path / "zone")
    data = [("LUR", "IND", "2020", "4"), ("LUR", "USA", "2020", "8")]
    df = spark.createDataFrame(data, "indicator string, country string, year string, value string").withColumns(
        {"source": F.lit("imf"), "dataset": F.lit("indicators")}
    )
    write_raw_zone(df, base, "2024-02-03T04:05:06+00:00")
    folder = tmp_path / "zone" / "source=imf" / "dataset=indicators" / "ingestion_date=2024-02-03"
    (folder / "bad.json").write_text('{"indicator": \n')
    drain_landing(spark, spec, base, str(tmp_path / "cp"), layers, "2024-02-04").awaitTermination()
    silver = spark.table(spec.table(layers.silver, "clean"))
    assert rows(silver, "country", "value", "source", "dataset") == [
        ("IND", 4.0, "imf", "indicators"), ("USA", 8.0, "imf", "indicators"),
    ]
    assert rows(spark.table(f"{layers.ops}.quarantine"), "line") == [('{"indicator": ',)]


def test_registry():
    assert len(DATASETS) == 17 and set(DATASETS) < set(ALL_DATASETS)
    assert find("financial_markets", "financial_modeling_prep", "industry_historical").options["level"] == "industry"
    assert find("american_markets", "alphavantage", "time_series_daily").name == "market_daily"
    with pytest.raises(RegistryError):
        find("a", "b", "c")
    market = DATASETS["market_daily"]
    for change, match in (
        ({"flattener": "nothing"}, "no flattener"),
        ({"keys": ("symbol", "nope")}, "unknown columns"),
        ({"partition": "close"}, "must be a key"),
        ({"hash_columns": ()}, "without hash"),
        ({"style": "cdc"}, "unknown style"),
    ):
        with pytest.raises(RegistryError, match=match):
            load([registry.DatasetSpec(**{**market.__dict__, **change})])
    with pytest.raises(RegistryError, match="twice"):
        load([market, market])
    with pytest.raises(ValueError, match="raw zone"):
        from stratalake.plans.jobs import process_batch

        process_batch(None, DATASETS["trending"], None, Run("r", "2024-01-01"))


def contents(spark, layers):
    """The rows of every silver and gold table, but their processing times."""
    out = {}
    for db in (layers.silver, layers.gold):
        if spark.catalog.databaseExists(db):
            for t in spark.catalog.listTables(db):
                df = spark.table(f"{db}.{t.name}")
                out[t.name] = rows(df, *[c for c in df.columns if c != "processed_at"])
    return out


def test_a_refused_run_changes_no_table(spark, layers, tmp_path, monkeypatch):
    """Whatever gate refuses, silver and gold stay; the log tells why."""
    from stratalake.plans import jobs

    spec = DATASETS["macro_indicators"]

    def cell(indicator, country, year, value):
        return {"indicator": indicator, "country": country, "year": year, "value": value}

    run_dataset(spark, spec, [land(tmp_path, "1", cell("LUR", "IND", 2020, 4), cell("LUR", "USA", 2020, 8))], Run("r1", "2024-02-01"), layers)
    before = contents(spark, layers)
    assert len(before) == 4
    key = land(tmp_path, "2", cell("LUR", "USA", 2020, 2), cell("PCPIPCH", "USA", 2021, 1))

    def refused(match, run):
        with pytest.raises(GateError, match=match):
            run_dataset(spark, spec, [key], run, layers)
        assert contents(spark, layers) == before

    refused("announced 7", Run("r2", "2024-02-02", record_count=7))
    refused("before that of a stored version", Run("r3", "2024-01-31"))
    real = jobs.index_scores
    monkeypatch.setattr(jobs, "index_scores", lambda df, index: real(df, index).withColumn("macro_resilience_score", F.lit(101.0)))
    refused("scores", Run("r4", "2024-02-02"))
    monkeypatch.undo()
    log = spark.table(f"{layers.ops}.dataset_runs").where("run_id <> 'r1'")
    assert rows(log, "run_id", "status", "bronze_rows") == [("r2", "refused", 2), ("r3", "refused", 2), ("r4", "refused", 2)]
    assert log.where("problem IS NULL").isEmpty()
    run_dataset(spark, spec, [key], Run("r5", "2024-02-02"), layers)
    assert contents(spark, layers) != before


def test_values_that_do_not_convert_are_counted(spark, layers, tmp_path):
    spec = DATASETS["market_daily"]
    key = land(tmp_path, "1", bar("A", "2024-01-01", "NaN"), bar("A", "2024-01-02", "x"), bar("A", "2024-01-03", 3, volume="many"), bar("A", "2024-01-04", "Infinity"))
    run_dataset(spark, spec, [key], Run("r1", "2024-02-01"), layers)
    assert rows(spark.table(spec.table(layers.gold, "fact")), "close", "volume") == [(3.0, None), (None, 10), (None, 10), (None, 10)]
    log = spark.table(f"{layers.ops}.dataset_runs").first()
    assert log["cast_failures"] == {"close": 3, "volume": 1} and log["keys"] == [key] and log["status"] == "done"


def test_permissive_counts_and_replays(spark, layers, tmp_path):
    """Malformed lines count as announced records, and a replay stores them once."""
    spec = DATASETS["macro_indicators"]
    key = land(tmp_path, "1", {"indicator": "LUR", "country": "IND", "year": 2020, "value": None})
    with open(key, "a") as f:
        f.write('[{"indicator": "LUR", "country": "USA", "year": 2020, "value": 5}, {"indicator": "LUR", "country": "FRA", "year": 2020, "value": 6}]\n{"cut": \n')
    with pytest.raises(GateError, match="announced 9"):
        run_dataset(spark, spec, [key], Run("r1", "2024-02-01", record_count=9), layers)
    for _ in range(2):
        run_dataset(spark, spec, [key], Run("r1", "2024-02-01", record_count=4), layers)
    assert rows(spark.table(f"{layers.ops}.quarantine"), "run_id", "line") == [("r1", '{"cut": ')]
    assert rows(spark.table(f"{layers.ops}.dataset_runs"), "run_id", "status", "bronze_rows", "quarantined") == [("r1", "done", 3, 1)]
    assert spark.table(spec.table(layers.gold, "fact")).count() == 3


def test_a_batch_of_nulls_is_valid(spark, layers, tmp_path):
    spec = DATASETS["macro_indicators"]
    key = land(tmp_path, "1", {"indicator": "LUR", "country": "IND", "year": 2020, "value": None})
    run_dataset(spark, spec, [key], Run("r1", "2024-02-01"), layers)
    assert rows(spark.table(spec.table(layers.gold, "fact")), "country", "value") == [("IND", None)]


BATCHES = {
    "market_daily": [
        [bar("A", d, i) for i, d in enumerate(days(28))] + [bar("B", "2024-01-02", 5)],
        [bar("A", "2024-01-05", 50), bar("B", "2024-01-30", 6)],
        [bar("A", "2024-01-01", 7), bar("A", "2024-01-31", 7), bar("C", "2024-01-03", 1), bar("B", "2024-01-30", 9)],
    ],
    "commodity_prices": [
        [{"commodity": n, "symbol": "WTI", "interval": i, "date": d, "value": v, "unit": u} for n, i, d, v, u in batch]
        for batch in (
            [("Crude", "daily", "2024-01-01", 70, "USD"), ("Crude", "daily", "2024-01-02", 1, "USD")],
            [("Oil", "weekly", "2024-01-01", 71, "EUR")],
            [("Later", "x", "2024-01-01", 72, "INR"), ("New", "y", "2024-01-09", 3, "USD")],
        )
    ],
    "macro_indicators": [
        [{"indicator": n, "country": c, "year": y, "value": v} for n, c, y, v in batch]
        for batch in (
            [("LUR", "IND", 2020, 4), ("LUR", "USA", 2020, 8)],
            [("LUR", "IND", 2020, 5), ("PCPIPCH", "IND", 2021, 1)],
            [("LUR", "FRA", 2020, 1), ("NGDP_RPCH", "USA", 2022, 3), ("LUR", "IND", 2020, 6)],
        )
    ],
}


@pytest.mark.parametrize("name", list(BATCHES))
def test_roll_back_is_the_state_after_that_run(spark, layers, tmp_path, name):
    spec, states = DATASETS[name], []
    for n, batch in enumerate(BATCHES[name], 1):
        run_dataset(spark, spec, [land(tmp_path, str(n), *batch)], Run(f"r{n}", f"2024-03-0{n} 00:00:00"), layers)
        states.append(contents(spark, layers))
    for n in (2, 1):
        roll_back(spark, spec, f"2024-03-0{n} 00:00:00", layers, f"back to {n}")
        assert contents(spark, layers) == states[n - 1]
    roll_back(spark, spec, "2024-03-05 00:00:00", layers, "nothing later")
    assert contents(spark, layers) == states[0]
    assert rows(spark.table(f"{layers.ops}.dataset_runs").where("status = 'rolled back'"), "run_id") == [("back to 1",), ("back to 2",), ("nothing later",)]
    # the next run goes on from there
    run_dataset(spark, spec, [land(tmp_path, "again", *BATCHES[name][1])], Run("r2", "2024-03-02 00:00:00"), layers)
    again = contents(spark, layers)
    assert {k: v for k, v in again.items() if not k.endswith("clean")} == {k: v for k, v in states[1].items() if not k.endswith("clean")}


def test_change_log_tells_what_a_roll_back_reads(spark, layers, tmp_path):
    """Only partitions that later runs replaced; before the log begins there is no telling."""
    from stratalake.plans.jobs import _changed_since

    spec = DATASETS["market_daily"]
    days = [bar("A", f"2024-01-0{d}", d) for d in range(1, 8)]
    run_dataset(spark, spec, [land(tmp_path, "1", *days)], Run("r1", "2024-02-01"), layers)
    run_dataset(spark, spec, [land(tmp_path, "2", bar("A", "2024-01-02", 9), bar("A", "2024-01-06", 9))], Run("r2", "2024-02-02"), layers)
    run_dataset(spark, spec, [land(tmp_path, "2", bar("A", "2024-01-02", 9))], Run("r2", "2024-02-02"), layers)
    run_dataset(spark, spec, [land(tmp_path, "3", bar("B", "2024-01-09", 1))], Run("r3", "2024-02-03"), layers)

    def since(moment, layers=layers):
        found = _changed_since(spark, spec, F.lit(moment).cast("timestamp"), layers)
        return None if found is None else [str(r[0]) for r in found.orderBy("trade_date").collect()]

    assert since("2024-02-02") == ["2024-01-09"]
    # the second run was replayed with fewer rows: what its first try replaced stays in the log
    assert since("2024-02-01") == ["2024-01-02", "2024-01-06", "2024-01-09"]
    assert since("2024-01-31") is None and since("2024-02-04") == []
    assert since("2024-02-02", replace(layers, ops=f"{layers.ops}_other")) is None


def test_a_run_replaces_the_tails_of_its_entities_only(spark, layers, tmp_path):
    spec = DATASETS["market_daily"]
    name = spec.table(layers.gold, "tails")
    many = [bar(f"S{n}", f"2024-01-0{d}", d) for n in range(40) for d in (1, 2)]
    run_dataset(spark, spec, [land(tmp_path, "1", *many)], Run("r1", "2024-02-01"), layers)

    def files():
        return {r[0] for r in spark.table(name).select(F.input_file_name()).distinct().collect()}

    before = files()
    assert len({f.split("part=")[1].split("/")[0] for f in before}) > 10
    run_dataset(spark, spec, [land(tmp_path, "2", bar("S7", "2024-01-03", 3))], Run("r2", "2024-02-02"), layers)
    spark.catalog.refreshTable(name)
    new = files() - before
    assert len({f.split("part=")[1].split("/")[0] for f in new}) == 1 and len(before - files()) <= 1
    assert spark.table(name).count() == 81


def test_a_run_writes_no_closed_versions_of_earlier_runs(spark, layers, tmp_path):
    """What a run closes is a partition of its own; a replay of the run doesn't lose it."""
    spec = DATASETS["macro_indicators"]
    name = spec.table(layers.silver, "clean")

    def run(n, value):
        cell = {"indicator": "LUR", "country": "IND", "year": 2020, "value": value}
        run_dataset(spark, spec, [land(tmp_path, str(n), cell)], Run(f"r{n}", f"2024-02-0{n}"), layers)
        spark.catalog.refreshTable(name)

    def files():
        closed = spark.table(name).where("closed_by <> 'current'")
        return {r[0]: r[1] for r in closed.select("closed_by", F.input_file_name()).collect()}

    run(1, 4)
    assert files() == {}
    run(2, 5)
    before = files()
    run(3, 6)
    after = files()
    assert sorted(after) == ["macro_indicators@r2", "macro_indicators@r3"]
    assert after["macro_indicators@r2"] == before["macro_indicators@r2"]
    run(3, 6)
    assert files() == after
    assert rows(spark.table(name), "value", "is_current") == [(4.0, False), (5.0, False), (6.0, True)]


def test_append_tables_cannot_be_rolled_back(spark, layers):
    with pytest.raises(ValueError, match="keeps no versions"):
        roll_back(spark, DATASETS["spot_prices"], "2024-01-01", layers)


def responses(spark, *bodies, url="https://x/api?apikey=secret&q=1", **parameters):
    data = [(json.dumps(b) if not isinstance(b, str) else b, url, "2024-01-31T00:00:00+00:00", *parameters.values()) for b in bodies]
    return spark.createDataFrame(data, ", ".join(["payload string, request_url string, received_at string", *[f"{p} string" for p in parameters]]))


def test_from_payloads_to_metrics(spark, layers, tmp_path):
    spec, base = DATASETS["market_daily"], str(tmp_path / "zone")
    day = {f"{i}. {n}": str(v) for i, (n, v) in enumerate({"open": 1, "high": 2, "low": 1, "close": 1.5, "volume": 10}.items(), 1)}
    body = {"Time Series (Daily)": {"2024-01-01": day, "2024-01-02": day, "2024-01-03": "closed"}}
    raw = responses(spark, body, {"error": "quota"}, "{", symbol="AAPL")
    done = ingest(spark, spec, raw, base, "2024-02-01T00:00:00+00:00", layers)
    assert (done.record_count, done.rejected) == (2, 3) and all("source=alphavantage" in k for k in done.keys)
    run_manifest(spark, done.manifest, "r1", "2024-02-01 06:00:00", layers, base_path=base)
    assert rows(spark.table(spec.table(layers.gold, "metrics")), "symbol", "close", "ma_5_close") == [("AAPL", 1.5, 1.5)] * 2
    silver = spark.table(spec.table(layers.silver, "clean"))
    assert {r[0] for r in silver.select("request_url").collect()} == {"https://x/api?apikey=REDACTED&q=1"}
    bad = spark.table(f"{layers.ops}.rejected")
    assert rows(bad, "problem") == [("error: quota",), ("not an object",), ("not json",)] and bad.where("request_url LIKE '%secret%'").isEmpty()
    # a second ingestion of the day names its own objects only
    again = ingest(spark, spec, raw, base, "2024-02-01T09:00:00+00:00", layers)
    assert again.keys and not set(again.keys) & set(done.keys)
    apart = ingest(spark, spec, raw, f"{base}-entities", "2024-02-01T09:00:00+00:00", layers, entity="symbol")
    assert apart.keys and all("entity=AAPL" in k for k in apart.keys)
    with pytest.raises(GateError, match="not successful"):
        run_manifest(spark, again.manifest.replace("SUCCESS", "FAILED"), "r2", "2024-02-02", layers)
    with pytest.raises(GateError, match="no records"):
        ingest(spark, spec, raw.where("payload = '{'"), base, "2024-02-02T00:00:00+00:00", layers)


@pytest.mark.parametrize("entity", [None, "symbol"])
def test_ingestion_can_be_tried_again(spark, layers, tmp_path, monkeypatch, entity):
    """A replay, and a try after one that failed before its manifest, give the keys and the count of a single try."""
    from stratalake.plans import ingest as module

    spec, base = DATASETS["market_daily"], str(tmp_path / "zone")
    day = {"1. open": "1", "5. volume": "10"}
    raw = responses(spark, {"Time Series (Daily)": {f"2024-01-{d:02}": day for d in range(1, 21)}}, "{", symbol="AAPL")
    at = "2024-02-01T00:00:00+00:00"

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(module, "publish_text", fail)
        with pytest.raises(OSError):
            ingest(spark, spec, raw, base, at, layers, entity=entity)
    done = ingest(spark, spec, raw, base, at, layers, entity=entity)
    assert (done.record_count, done.rejected) == (20, 1)
    assert spark.read.text(list(done.keys)).count() == 20 == spark.read.text(base).count()
    assert ingest(spark, spec, raw, base, at, layers, entity=entity) == done
    # an ingestion of another dataset at the same time, whose name begins alike, is apart
    other = ingest(spark, replace(spec, name="market_daily_2", dataset="time_series_daily_2"), raw, base, at, layers, entity=entity)
    assert not set(other.keys) & set(done.keys) and other.record_count == 20
    run_manifest(spark, done.manifest, "r1", "2024-02-01 06:00:00", layers, base_path=base)
    assert spark.table(spec.table(layers.gold, "fact")).count() == 20
    assert spark.table(f"{layers.ops}.rejected").where("dataset = 'market_daily'").count() == 1


def test_every_dataset_can_be_ingested(spark, layers, tmp_path):
    point = {"ticker": "A", "price": 1, "52_week_high": 2}
    bodies = {
        "date_map": {"Time Series (Daily)": {"2024-01-01": {}}},
        "series": {"data": [{"date": "2024-01-01", "value": 1}]},
        "nested_map": {"values": {"LUR": {"IND": {"2020": 1}}}},
        "rate_map": {"status": "success", "metals": {"gold": 1}},
        "values": {"meta": {"symbol": "X"}, "values": [{"datetime": "2024-01-01"}]},
        "articles": {"articles": [{"url": "u"}]},
        "swings": {"NSE_52WeekHighLow": {"high52Week": [point]}},
        "risk_premium": [{"country": "India"}],
        "performance": [{"sector": "Energy", "industry": "Energy"}],
        "locations": [{"city": "Goa", "price": 1, "date": "2024-01-01"}],
        "whole_payload": {"anything": 1},
    }
    for spec in ALL_DATASETS.values():
        raw = responses(spark, bodies[spec.flattener], symbol="S", request_dataset=spec.dataset, location="Goa", stock_name="X", period="1m", filter="pe", stats_type="ratios")
        parameters = {"entities": ["Energy"]} if spec.flattener == "performance" else {}
        done = ingest(spark, spec, raw, str(tmp_path / spec.name), "2024-02-01T00:00:00+00:00", layers, parameters)
        assert (done.record_count, done.rejected, len(done.keys)) == (1, 0, 1), spec.name
    with pytest.raises(RegistryError, match="period must be one of"):
        ingest(spark, DATASETS["historical_data"], raw, str(tmp_path), "2024-02-01T00:00:00+00:00", layers, {"period": "2h"})


def test_an_ingestion_stores_its_rows_once(spark, layers, tmp_path, monkeypatch):
    """What is found in the responses is stored; the rows made of it are only written to the zone."""
    saved, save = [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df: saved.append(df.columns) or save(self, df))
    day = '{"1. open": "1", "2. high": "2", "3. low": "1", "4. close": "2", "5. volume": "3"}'
    payload = '{"Time Series (Daily)": {"2024-01-01": %s, "2024-01-02": %s, "early": [1]}}' % (day, day)
    raw = spark.createDataFrame([("A", payload, "/q", "2024-02-01T00:00:00+00:00")], "symbol string, payload string, request_url string, received_at string")
    done = ingest(spark, DATASETS["market_daily"], raw, str(tmp_path / "zone"), "2024-02-01T00:00:00+00:00", layers)
    assert (done.record_count, done.rejected, len(saved)) == (2, 1, 1)
    assert spark.read.json(str(tmp_path / "zone" / "source=alphavantage")).count() == 2


def test_counts_for_the_gates_with_more_columns_than_bits(spark, tmp_path):
    """Flags of a line are stored as bits of as many numbers as they take."""
    columns = {f"c{i}": "int" for i in range(70)}
    spec = replace(DATASETS["market_daily"], columns=columns, keys=("c0",), required=("c1", "c69", "gone"), month_of=None, renames={}, hash_columns=("c0",))
    good = {f"c{i}": i for i in range(69)}
    path = land(tmp_path, "wide", good | {"c69": None}, good | {"c0": None, "c68": "x", "c69": "7"}, good | {"c68": "y", "c5": "z"})
    bronze = scan_bronze(spark, [path], spec.bronze_columns, "PERMISSIVE", members=True)
    with Scratch(spark, "wide") as scratch:
        stored, found = _staged_bronze(bronze, spec, Run("r", "2024-02-01 00:00:00"), scratch)
        assert set(stored.columns) == {*spec.silver_columns, "_corrupt_record"} and stored.count() == 3
    assert (found["good"], found["bad"], found["null c0"], found["failed c68"], found["failed c5"], found["failed c69"]) == (3, 0, 1, 2, 1, 0)
    assert found["has c69"] == 2 and found["absent"] == ["gone"]
