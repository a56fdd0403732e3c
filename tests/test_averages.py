"""Averages that runs maintain equal those of a recompute."""

from __future__ import annotations

import datetime
import uuid

import pytest

from stratalake.operators.quality import GateError
from stratalake.operators.rolling import RollingSpec, averages_of, month_sums
from stratalake.plans.averages import refresh_averages, stored_averages

from .conftest import rows

SPEC = RollingSpec(value="cents")
_SCHEMA = "symbol string, trade_date date, cents bigint"


def _days(spark, *items):
    return spark.createDataFrame([(s, d and datetime.date.fromisoformat(d), v) for s, d, v in items], _SCHEMA)


@pytest.fixture
def name(spark, tmp_path):
    def refresh(as_of, came, gone=None):
        refresh_averages(spark, table, SPEC, as_of, came, gone, location=str(tmp_path))

    table = f"averages_{uuid.uuid4().hex[:8]}.by_month"
    refresh.table = table
    return refresh


def _equal(spark, refresh, *everything):
    assert rows(stored_averages(spark, refresh.table, SPEC)) == rows(averages_of(month_sums(_days(spark, *everything), SPEC), SPEC))


A, B, LATE = ("a", "2024-01-02", 10), ("a", "2024-03-01", 31), ("a", "2024-01-09", 7)
NULLS = [("a", "2024-01-03", None), (None, "2024-01-03", 5), ("b", None, 3), ("c", "2023-12-31", None)]


def test_late_rows_corrections_and_removals(spark, name):
    name("2024-04-01 00:00:00", _days(spark, A, B, *NULLS))
    _equal(spark, name, A, B, *NULLS)
    corrected = ("a", "2024-03-01", 50)
    name("2024-05-01 00:00:00", _days(spark, LATE, corrected), _days(spark, B))
    _equal(spark, name, A, LATE, corrected, *NULLS)
    name("2024-06-01 00:00:00", _days(spark), _days(spark, corrected, NULLS[2]))  # months without rows are gone
    _equal(spark, name, A, LATE, NULLS[0], NULLS[1], NULLS[3])


def test_a_run_again_adds_nothing_twice(spark, name):
    name("2024-04-01 00:00:00", _days(spark, A, *NULLS))
    for _ in range(3):
        name("2024-05-01 00:00:00", _days(spark, B, LATE), _days(spark, A))
    _equal(spark, name, B, LATE, *NULLS)


def test_a_half_published_run_is_finished_by_the_next_try(spark, name, monkeypatch):
    from stratalake.sources import tables

    name("2024-04-01 00:00:00", _days(spark, A, ("a", "2023-05-05", 1)))
    whole = tables.publish_partitions

    def half(df, table, partition):
        whole(df.where("year = 2023"), table, partition)
        raise RuntimeError("lost")

    late = [("a", "2023-05-06", 2), LATE]
    with monkeypatch.context() as patch:
        patch.setattr(tables, "publish_partitions", half)
        with pytest.raises(RuntimeError):
            name("2024-05-01 00:00:00", _days(spark, *late))
    name("2024-05-01 00:00:00", _days(spark, *late))
    _equal(spark, name, A, ("a", "2023-05-05", 1), *late)


def test_earlier_runs_are_refused_and_other_years_stay(spark, name):
    name("2024-04-01 00:00:00", _days(spark, A, ("a", "2023-05-05", 1)))
    name("2024-05-01 00:00:00", _days(spark, LATE))
    with pytest.raises(GateError):
        name("2024-04-15 00:00:00", _days(spark, B))
    at = {r["year"]: str(r["run_at"]) for r in spark.table(name.table).collect()}
    assert at == {2023: "2024-04-01 00:00:00", 2024: "2024-05-01 00:00:00"}
