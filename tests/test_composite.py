import pytest
from pyspark.sql import functions as F

from stratalake.operators.composite import minmax_norm, pivot_norms, weighted_channels
from stratalake.plans.jobs import index_scores
from stratalake.plans.registry import FULL_CHANNELS, MACRO_INDEX

from .conftest import rows

DATA = [
    ("LUR", "IND", 2020, 4.0), ("LUR", "USA", 2020, 8.0), ("LUR", "FRA", 2020, 6.0), ("LUR", "DEU", 2020, None),
    ("LUR", "IND", 2021, 4.0),  # alone: neutral
    ("LUR", "IND", 2022, 4.0), ("LUR", "USA", 2022, None),  # constant, one NULL
    ("LUR", "IND", 2023, None),  # nothing known
    ("BCA_NGDPD", "IND", 2020, -1.0), ("BCA_NGDPD", "USA", 2020, 1.0),
    ("OTHER", "XXX", 2020, 1.0), ("OTHER", "XXX", None, 1.0), ("OTHER", "YYY", None, 3.0),
]


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(DATA, "indicator string, country string, year int, value double")


def test_norms(data):
    got = {(r.indicator, r.country, r.year): r.norm for r in minmax_norm(data).collect()}
    assert got[("LUR", "FRA", 2020)] == 50.0 and got[("LUR", "USA", 2020)] == 100.0
    assert got[("LUR", "DEU", 2020)] is None
    assert got[("LUR", "IND", 2021)] == 50.0
    assert got[("LUR", "USA", 2022)] == 50.0
    assert got[("LUR", "IND", 2023)] is None
    assert got[("OTHER", "YYY", None)] == 100.0 and len(got) == len(DATA)


def test_norms_are_one_lazy_plan(spark, data):
    """Nothing runs while the plan is built."""
    tracker, group = spark.sparkContext.statusTracker(), "plan of norms"
    spark.sparkContext.setJobGroup(group, group)
    try:
        weighted_channels(pivot_norms(minmax_norm(data), MACRO_INDEX.indicators), MACRO_INDEX.channels, 50.0)
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_direction(data):
    flipped = minmax_norm(data, directions={"LUR": -1})
    assert rows(flipped.where("country = 'USA' AND year = 2020"), "indicator", "norm") == [("BCA_NGDPD", 100.0), ("LUR", 0.0)]


def test_scores(data):
    got = {(r.country, r.year): r for r in index_scores(data, MACRO_INDEX).collect()}
    assert set(got) == {("IND", y) for y in (2020, 2021, 2022, 2023)} | {("USA", 2020), ("USA", 2022), ("FRA", 2020), ("DEU", 2020)}
    usa = got[("USA", 2020)]
    assert (usa.trade_exposure_score, usa.competitiveness_score, usa.macro_resilience_score) == (100.0, 50.0, 70.0)
    assert usa.coverage_ratio == 0.5
    assert usa.tvi_score == pytest.approx(0.35 * 100 + 0.2 * 50 + 0.25 * 70 + 0.2 * 50)
    assert got[("DEU", 2020)].coverage_ratio == 0.0
    assert got[("USA", 2022)].coverage_ratio == 0.25
    assert all(0 <= r.tvi_score <= 100 for r in got.values())


def test_pivot_equals_outer_joins(data):
    normed = minmax_norm(data)
    names = MACRO_INDEX.indicators
    joined = None
    for name in names:
        one = normed.where(F.col("indicator") == name).select("country", "year", F.col("norm").alias(f"{name}_norm"))
        joined = one if joined is None else joined.join(one, ["country", "year"], "outer")
    assert rows(pivot_norms(normed, names).select(*joined.columns)) == rows(joined)


def test_full_channels_need_every_indicator(spark):
    names = [i for w in FULL_CHANNELS.values() for i in w]
    wide = spark.range(1).select(*[F.lit(None if n == "LUR" else 40.0).cast("double").alias(f"{n}_norm") for n in names])
    got = weighted_channels(wide, FULL_CHANNELS).first()
    assert got.macro_resilience_score is None
    assert got.trade_exposure_score == pytest.approx(40.0)
