from pyspark.sql import functions as F

from stratalake.operators.dedup import duplicate_keys, latest_wins
from stratalake.operators.merge import (
    scd2_as_of,
    scd2_current,
    scd2_history,
    scd2_merge,
    scd2_reopen,
    scd2_violations,
    upsert,
)
from stratalake.operators.quality import GateError, enforce, history_report
from stratalake.operators.standardize import with_history_columns

import pytest

from .conftest import rows

KEYS = ["symbol", "day"]


def batch(spark, data, as_of, ingested="2024-01-01 00:00:00"):
    df = spark.createDataFrame(data, "symbol string, day int, value double").withColumn(
        "ingested_at", F.lit(ingested).cast("timestamp")
    )
    return with_history_columns(df, ["symbol", "day", "value"], as_of)


def state(df):
    return rows(
        df.select(
            "symbol", "day", "value",
            F.date_format("effective_from", "dd").alias("a"), F.date_format("effective_to", "dd").alias("b"), "is_current",
        )
    )


def test_changed_key_closes_and_opens(spark):
    first = batch(spark, [("A", 1, 1.0), ("B", 1, 5.0), ("C", 1, None)], "2024-01-01")
    second = batch(spark, [("A", 1, 2.0), ("B", 1, 5.0), ("C", 1, 7.0), ("D", 1, 1.0)], "2024-01-02")
    merged = scd2_merge(first, second, KEYS)
    assert state(merged) == [
        ("A", 1, 1.0, "01", "02", False),
        ("A", 1, 2.0, "02", None, True),
        ("B", 1, 5.0, "01", None, True),
        ("C", 1, 7.0, "02", None, True),
        ("C", 1, None, "01", "02", False),
        ("D", 1, 1.0, "02", None, True),
    ]
    assert scd2_violations(merged, KEYS).count() == 0
    assert state(scd2_merge(merged, second, KEYS)) == state(merged)  # replay


def test_changed_back_opens_a_third_version(spark):
    table = batch(spark, [("A", 1, 1.0)], "2024-01-01")
    table = scd2_merge(table, batch(spark, [("A", 1, 2.0)], "2024-01-02"), KEYS)
    table = scd2_merge(table, batch(spark, [("A", 1, 1.0)], "2024-01-03"), KEYS)
    assert state(table) == [
        ("A", 1, 1.0, "01", "02", False),
        ("A", 1, 1.0, "03", None, True),
        ("A", 1, 2.0, "02", "03", False),
    ]
    assert scd2_history(table, KEYS).count() == 3
    assert scd2_current(table).count() == 1


def test_null_keys_match_themselves(spark):
    table = batch(spark, [(None, 1, 1.0)], "2024-01-01")
    merged = scd2_merge(table, batch(spark, [(None, 1, 1.0)], "2024-01-02"), KEYS)
    assert merged.count() == 1
    changed = scd2_merge(table, batch(spark, [(None, 1, 2.0)], "2024-01-02"), KEYS)
    assert scd2_history(changed, KEYS).count() == 2


def test_null_position_changes_the_hash(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    hashed = with_history_columns(df, ["x", "y", "z"], "2024-01-01")
    assert hashed.select("record_hash").distinct().count() == 2


def test_late_batch(spark):
    table = batch(spark, [("A", 1, 2.0)], "2024-01-02", "2024-01-02 00:00:00")
    late = batch(spark, [("A", 1, 1.0), ("B", 1, 1.0)], "2024-01-03", "2024-01-01 00:00:00")
    assert scd2_merge(table, late, KEYS).count() == 3
    guarded = scd2_merge(table, late, KEYS, require_newer=True)
    assert state(guarded) == [("A", 1, 2.0, "02", None, True), ("B", 1, 1.0, "03", None, True)]


def test_as_of_restores_each_run(spark):
    one = batch(spark, [("A", 1, 1.0), ("B", 1, 1.0)], "2024-01-01")
    two = scd2_merge(one, batch(spark, [("A", 1, 2.0), ("C", 1, 1.0)], "2024-01-02"), KEYS)
    three = scd2_merge(two, batch(spark, [("A", 1, 3.0), ("B", 1, 2.0)], "2024-01-03"), KEYS)
    assert state(scd2_as_of(three, "2024-01-01")) == state(one)
    assert state(scd2_as_of(three, "2024-01-02")) == state(two)
    assert state(scd2_as_of(three, "2024-01-03")) == state(three)


def test_intervals_do_not_overlap(spark):
    table = batch(spark, [("A", d, 0.0) for d in range(5)], "2024-01-01")
    for n in range(2, 6):
        new = batch(spark, [("A", d, float(n // (d + 1))) for d in range(5)], f"2024-01-0{n}")
        table = scd2_merge(table, new, KEYS)
    a, b = table.alias("a"), table.alias("b")
    end = F.coalesce(F.col("a.effective_to"), F.lit("9999-01-01").cast("timestamp"))
    overlapping = a.join(b, KEYS).where(
        (F.col("a.effective_from") < F.col("b.effective_from")) & (end > F.col("b.effective_from"))
    )
    assert overlapping.count() == 0
    assert scd2_violations(table, KEYS).count() == 0


def test_reopen_and_invariants(spark):
    table = scd2_merge(batch(spark, [("A", 1, 1.0)], "2024-01-01"), batch(spark, [("A", 1, 2.0)], "2024-01-02"), KEYS)
    broken = table.where("NOT is_current")
    with pytest.raises(GateError, match="missing_current"):
        enforce(history_report(broken, KEYS), "t")
    fixed = scd2_reopen(broken, F.col("symbol") == "A", "2024-01-05")
    assert state(fixed) == [("A", 1, 1.0, "05", None, True)]
    enforce(history_report(fixed, KEYS), "t")
    with pytest.raises(GateError, match="multiple_current"):
        enforce(history_report(scd2_reopen(table, F.lit(True), "2024-01-05"), KEYS), "t")


def test_upsert(spark):
    schema = "symbol string, name string, value double, processed_at timestamp"
    target = spark.createDataFrame([("A", "old", 1.0, None), ("B", "keep", 2.0, None)], schema)
    source = spark.createDataFrame([("A", "new", None), ("C", "new", 3.0)], "symbol string, name string, value double")
    out = upsert(target, source, ["symbol"], ["value"], "processed_at", "2024-01-01")
    assert rows(out.select("symbol", "name", "value", F.col("processed_at").isNotNull())) == [
        ("A", "old", None, True),
        ("B", "keep", 2.0, False),
        ("C", "new", 3.0, True),
    ]


def test_latest_wins(spark):
    df = spark.createDataFrame(
        [("A", 1, "x"), ("A", 2, "y"), ("A", 2, "z"), ("B", None, "n"), ("B", 1, "m"), (None, 1, "q"), (None, 2, "r")],
        "k string, ingested_at int, v string",
    )
    assert rows(latest_wins(df, ["k"])) == [("A", 2, "z"), ("B", 1, "m"), (None, 2, "r")]
    assert rows(duplicate_keys(df, ["k"])) == [("A", 3), ("B", 2), (None, 2)]
    assert duplicate_keys(latest_wins(df, ["k"]), ["k"]).count() == 0
