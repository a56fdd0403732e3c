"""The physical plans the library relies on."""

from pyspark.sql import functions as F

from stratalake.operators.dedup import latest_wins
from stratalake.operators.merge import scd2_merge
from stratalake.operators.rolling import RollingSpec, calendar_averages, refresh_rolling
from stratalake.operators.reports import article_search, average_by, most_recent
from stratalake.operators.standardize import with_history_columns
from stratalake.sources.tables import touched

from .conftest import plan_of

SF = "/root/testdata/sf0.01"


def test_latest_wins_drops_losers_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = plan_of(latest_wins(lines, ["l_orderkey", "l_linenumber"], "l_shipdate"))
    assert plan.count("Exchange") == 1
    assert plan.count("WindowGroupLimit") == 2
    before, after = plan.split("Exchange")
    assert "WindowGroupLimit" in before and "Partial" in after


def test_closed_versions_are_not_shuffled(spark, tmp_path):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderstatus")
    table = with_history_columns(orders, ["o_orderkey", "o_orderstatus"], "2024-01-01")
    table.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(scd2_merge(stored, stored.limit(10), ["o_orderkey"]))
    closed = plan.split("Union")[1].split("Generate inline")[0]
    assert "Exchange" not in closed.split("SortMergeJoin")[0]
    assert "EqualTo(is_current,true)" in plan


def test_calendar_averages_aggregate_before_the_shuffle(spark):
    """No window holds the rows of an entity: the shuffled ones are partial sums by month."""
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("trade_date"), F.col("l_tax").alias("close")
    )
    plan = plan_of(calendar_averages(lines, RollingSpec()))
    assert "partial_sum" in plan and plan.count("Window ") == 1
    assert "HashAggregate" in plan.split("Window ")[1]


def test_refresh_prunes_date_partitions(spark, tmp_path):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.col("l_suppkey").alias("symbol"), F.date_trunc("month", "l_shipdate").cast("date").alias("trade_date"), F.col("l_tax").alias("close")
    )
    lines.dropDuplicates(["symbol", "trade_date"]).write.partitionBy("trade_date").parquet(str(tmp_path / "f"))
    fact = spark.read.schema("symbol long, close double, trade_date date").parquet(str(tmp_path / "f"))
    plan = plan_of(refresh_rolling(fact, "2000-06-01", RollingSpec()))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("trade_date" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


def test_touched_partitions_prune_however_many_there_are(spark, tmp_path):
    """One value or 20 000: the scan is bounded by literals."""
    spark.range(3).selectExpr("id", "id AS part").write.partitionBy("part").parquet(str(tmp_path / "t"))
    table = spark.read.schema("id long, part long").parquet(str(tmp_path / "t"))
    for n in (1, 20_000):
        part = touched(table, spark.range(1, n + 1).select(F.col("id").alias("part")), "part")
        scan = next(line for line in plan_of(part).splitlines() if "FileScan" in line and "part#" in line)
        assert f"(part#" in scan.split("PartitionFilters: [")[1] and f"<= {n})" in scan.split("PartitionFilters: [")[1]
        assert part.count() == min(2, n)


def test_filters_and_columns_reach_the_scan(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    plan = plan_of(average_by(events, "event_type", "value", ["view", "click"]))
    assert "In(event_type, [click,view])" in plan or "In(event_type, [view,click])" in plan
    assert "ReadSchema: struct<event_type:string,value:double>" in plan


def test_top_k_is_not_a_sort(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").withColumnRenamed("event_type", "symbol").withColumnRenamed("ts", "trade_date")
    plan = plan_of(most_recent(events, "view", ["symbol", "value"]))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    pages = spark.createDataFrame([], "article_url string, title string, description string, published_at timestamp")
    assert "TakeOrderedAndProject" in plan_of(article_search(pages, ["a"], page=3))


def test_payloads_are_read_once(spark):
    """Each level of a payload is read by one expression, and what is taken apart is not carried to its elements."""
    from stratalake.operators import flatten

    raw = spark.createDataFrame([("{}", "", "", "")], "payload string, request_url string, received_at string, symbol string")
    levels = {"date_map": 4, "series": 3, "values": 3, "articles": 3, "rate_map": 2, "swings": 4, "nested_map": 4}
    for name, reads in levels.items():
        plan = plan_of(getattr(flatten, name)(raw))
        # the map of the outermost members is read besides in a date map
        assert plan.count("from_json(") == reads + (name == "date_map"), name
        for line in plan.splitlines():
            if "Generate explode" in line or "Generate posexplode" in line:
                carried = line.split("[")[1].split("]")[0]
                assert not any(c in carried for c in ("payload", "_inside", "_s#", "item", "broken")), line


def test_only_the_batch_s_partitions_are_read(spark, tmp_path):
    """One row of the first and one of the last partition: nothing between them is read."""
    spark.range(40).selectExpr("id", "id AS part").write.partitionBy("part").parquet(str(tmp_path / "t"))
    table = spark.read.schema("id long, part long").parquet(str(tmp_path / "t"))
    batch = spark.createDataFrame([(0,), (39,), (39,)], "part long")
    part = touched(table, batch, "part")
    assert "dynamicpruning" in plan_of(part)
    assert sorted(r["id"] for r in part.collect()) == [0, 39]
    final = plan_of(part)
    reader = part.select("id", F.input_file_name().alias("f"))
    assert {r["f"].split("part=")[1].split("/")[0] for r in reader.collect()} == {"0", "39"} and "FileScan" in final
    odd = touched(table, spark.createDataFrame([(None,), (3,)], "part long"), "part")
    assert [r["id"] for r in odd.collect()] == [3]
    assert touched(table, spark.createDataFrame([], "part long"), "part").count() == 0
