import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators.rolling import (
    RollingSpec,
    add_rolling,
    calendar_averages,
    refresh_changed,
    refresh_rolling,
    rolling_in_pieces,
)

from .conftest import rows

OUT = ["symbol", "ma_5_close", "ma_20_close", "daily_return", "volatility_20"]


def same(a, b, *key):
    cols = [*key, *[F.round(c, 9).alias(c) if c != "symbol" else F.col(c) for c in OUT]]
    left, right = rows(a.select(*cols)), rows(b.select(*cols))
    assert left == right
    return left


@pytest.fixture(scope="module")
def daily(spark):
    rng = random.Random(5)
    data = []
    for symbol, days, chance in (("HOT", 400, 1.0), ("GAPS", 400, 0.1), ("RARE", 400, 0.02), ("NEW", 30, 1.0)):
        for d in range(days):
            if rng.random() < chance:
                day = dt.date(2023, 12, 31) - dt.timedelta(days=d)
                data.append((symbol, day, rng.choice([0.0, None, 1.0, 2.5, 7.25, 100.0])))
    data.append(("ONE", dt.date(2023, 12, 30), 5.0))
    return spark.createDataFrame(data, "symbol string, trade_date date, close double").cache()


@pytest.fixture
def many_pieces(spark):
    """As many pieces as shuffle partitions, however small."""
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_pieces_equal_plain(daily, many_pieces):
    spec = RollingSpec()
    assert len(same(rolling_in_pieces(daily, spec), add_rolling(daily, spec), "trade_date")) == daily.count()


def test_hot_series_is_cut(spark, many_pieces, monkeypatch):
    """An entity with nine tenths of the rows: no task holds much more than a piece, and results are equal."""
    from stratalake.operators import rolling

    ticks = spark.range(8000).select(
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("COLD"), F.col("id") % 50)).otherwise("HOT").alias("symbol"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 37).alias("ts"),
        F.col("id"),
        (F.col("id") * 7 % 113).cast("double").alias("close"),
    )
    spec = RollingSpec(order="ts", ties=("id",))
    sizes = []
    plain = rolling.add_rolling

    def spied(df, spec, groups=None):
        if groups:
            sizes.extend(r[0] for r in df.groupBy(*groups).count().select("count").collect())
        return plain(df, spec, groups)

    monkeypatch.setattr(rolling, "add_rolling", spied)
    assert same(rolling_in_pieces(ticks, spec), plain(ticks, spec), "id")
    assert len(sizes) > 30 and max(sizes) < 8000 / 40 * 3


@pytest.mark.parametrize("since", ["2023-12-01", "2023-12-20", "2022-11-01", "2023-12-31"])
def test_refresh_equals_full(daily, since):
    spec = RollingSpec()
    day = dt.date.fromisoformat(since)
    full = add_rolling(daily, spec).where(F.col("trade_date") >= F.lit(day))
    assert same(refresh_rolling(daily, day, spec), full, "trade_date")


def test_changed_rows_and_tails(spark, daily):
    """Batches in and out of order: the kept metrics and the replaced ones are those of a full recompute."""
    spec, rng = RollingSpec(), random.Random(9)
    rows_ = {(r["symbol"], r["trade_date"]): r["close"] for r in daily.collect()}
    days = sorted({d for _, d in rows_})
    stored = {k: v for k, v in rows_.items() if k[1] < days[200]}
    schema = "symbol string, trade_date date, close double"
    frame = lambda d: spark.createDataFrame([(*k, v) for k, v in d.items()], schema)
    full = lambda d: {(r["symbol"], r["trade_date"]): tuple(round(r[c], 9) if r[c] is not None else None for c in OUT[1:]) for r in add_rolling(frame(d), spec).collect()}
    metrics = full(stored)
    _, tails = refresh_changed(frame(stored), frame(stored), spec)
    tails = spark.createDataFrame(tails.collect(), schema)
    batches = [
        {k: v for k, v in rows_.items() if days[200] <= k[1] < days[230]},  # in order
        {k: 3.5 for k in rng.sample(sorted(stored), 3)},  # late corrections
        {("HOT", days[5]): 1.25, ("HOT", days[-1]): 2.0, ("FRESH", days[-1]): 7.0},  # old and new rows of one entity, a new one
    ]
    for batch in batches:
        stored |= batch
        changed = frame(batch).select("symbol", "trade_date")
        new, ends = refresh_changed(frame(stored), changed, spec, tails)
        got = {(r["symbol"], r["trade_date"]): tuple(round(r[c], 9) if r[c] is not None else None for c in OUT[1:]) for r in new.collect()}
        metrics |= got
        assert metrics == full(stored)
        assert {s for s, _ in got} == {s for s, _ in batch}
        others = tails.join(changed.select("symbol").distinct(), "symbol", "left_anti")
        tails = spark.createDataFrame([*others.collect(), *ends.collect()], schema)
        by = {}
        for s, d in stored:
            by.setdefault(s, []).append(d)
        assert {(r["symbol"], r["trade_date"]) for r in tails.collect()} == {(s, d) for s, x in by.items() for d in sorted(x)[-40:]}


def test_nothing_older_is_read_at_the_end_of_a_series(spark, daily):
    spec = RollingSpec()
    _, tails = refresh_changed(daily, daily, spec)
    tails = spark.createDataFrame(tails.collect(), tails.schema)
    more = daily.unionByName(spark.createDataFrame([("HOT", dt.date(2024, 1, 1), 1.0)], daily.schema))
    day = spark.createDataFrame([("HOT", dt.date(2024, 1, 1))], "symbol string, trade_date date")
    new, _ = refresh_changed(more, day, spec, tails)
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert new.count() == 1 and "trade_date" in plan
    assert not [x for x in plan.splitlines() if "Filter" in x and " < _first" in x and "trade_date" in x and "isnotnull(close" in x]


def test_calendar_averages(spark, daily):
    got = {(r["symbol"], r["trade_date"]): (r["monthly_avg_close"], r["yearly_avg_close"]) for r in calendar_averages(daily, RollingSpec()).collect()}
    data = daily.collect()
    assert len(got) == len(data)
    for r in data:
        for i, same_period in enumerate((lambda d: (d.year, d.month), lambda d: d.year)):
            known = [x["close"] for x in data if x["symbol"] == r["symbol"] and same_period(x["trade_date"]) == same_period(r["trade_date"]) and x["close"] is not None]
            expected = sum(known) / len(known) if known else None
            assert got[r["symbol"], r["trade_date"]][i] == (pytest.approx(expected) if known else None)


def test_edges(spark):
    data = [("A", dt.date(2024, 1, d), c) for d, c in ((1, 0.0), (2, 4.0), (3, None), (4, 5.0))]
    df = add_rolling(spark.createDataFrame(data, "symbol string, trade_date date, close double"), RollingSpec())
    assert [r[0] for r in df.orderBy("trade_date").select("daily_return").collect()] == [None, None, None, None]
    assert [r[0] for r in df.orderBy("trade_date").select("ma_5_close").collect()] == [0.0, 2.0, 2.0, 3.0]
    assert [r[0] for r in df.select("volatility_20").collect()] == [None] * 4
