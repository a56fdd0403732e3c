import json

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from stratalake.functions.payload import payload_value
from stratalake.operators.quality import not_recent, outside_domain, outside_range, quality_report, row_report
from stratalake.plans.manifest import manifest_gate, manifest_reconcile
from stratalake.session import shared_folder
from stratalake.sources import tables
from stratalake.sources.bronze import scan_bronze, scan_raw_zone, split_corrupt, write_per_entity, write_raw_zone
from stratalake.operators.reports import article_search, default_rollup

from .conftest import rows


def lines(path, *values):
    path.write_text("\n".join(v if isinstance(v, str) else json.dumps(v) for v in values) + "\n")
    return str(path)


def test_scan_needs_keys(spark):
    with pytest.raises(ValueError, match="no object keys"):
        scan_bronze(spark, [], ["a"])


def test_scan_reads_only_the_given_keys(spark, tmp_path):
    one, two, _ = (lines(tmp_path / f"{n}.jsonl", {"a": n, "b": 1.5}) for n in (1, 2, 3))
    assert rows(scan_bronze(spark, [one, two], ["a", "b"])) == [("1", "1.5"), ("2", "1.5")]


def test_scan_modes(spark, tmp_path):
    key = lines(tmp_path / "x.jsonl", {"a": 1}, '{"a": ', "", {"b": 2})
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        scan_bronze(spark, [key], ["a"]).collect()
    good, bad = split_corrupt(scan_bronze(spark, [key], ["a"], "PERMISSIVE"))
    assert rows(good) == [("1",), (None,)]
    assert bad.count() == 1
    assert rows(bad, "_corrupt_record") == [('{"a": ',)]


def test_raw_zone(spark, tmp_path):
    base = str(tmp_path / "zone")
    df = spark.createDataFrame([("u1", "s", "d", 1), ("u2", "s", "e", 2)], "URL string, source string, dataset string, n int")
    write_raw_zone(df, base, "2024-02-03T04:05:06+00:00")
    folder = tmp_path / "zone" / "source=s" / "dataset=d" / "ingestion_date=2024-02-03"
    assert folder.is_dir()
    lines(folder / "bad.json", "{broken")
    found = scan_raw_zone(spark, base, {"url": "string", "n": "bigint", "ingested_at": "timestamp"})
    assert rows(found.where("dataset = 'd'"), "url", "n", "dataset", F.col("ingestion_date").cast("string")) == [
        ("u1", 1, "d", "2024-02-03"),
        (None, None, "d", "2024-02-03"),
    ]
    plan = found.where("dataset = 'd'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan
    by_path = scan_bronze(spark, [str(folder)], ["URL", "n"], "PERMISSIVE", base_path=base)
    assert by_path.where("source = 's'").count() == 2


def test_per_entity(spark, tmp_path):
    df = spark.createDataFrame([("A", "s", "d"), ("A", "s", "d"), ("B", "s", "d")], "symbol string, source string, dataset string")
    counts = write_per_entity(df, str(tmp_path / "e"), F.col("symbol"), "2024-02-03T04:05:06+00:00")
    assert rows(counts) == [("A", 2), ("B", 1)]
    deep = spark.createDataFrame([('{"companyProfile": {"exchangeCodeNse": "TITAN"}}', "s", "d")], "data string, source string, dataset string")
    entity = payload_value(F.col("data"), "$.companyProfile.exchangeCodeNse", "string")
    assert rows(write_per_entity(deep, str(tmp_path / "g"), entity, "2024-02-03T04:05:06+00:00")) == [("TITAN", 1)]
    with pytest.raises(ValueError, match="no entity"):
        write_per_entity(df.withColumn("symbol", F.lit(None).cast("string")), str(tmp_path / "f"), F.col("symbol"), "2024-02-03")


def test_tables(spark, layers):
    name = f"{layers.silver}.t"
    columns = {"k": "int", "v": "string", "day": "string"}
    tables.create_table(spark, name, columns, "day", location=layers.location)
    tables.create_table(spark, name, columns, "day", location=layers.location)

    def frame(*data):
        return spark.createDataFrame(data, "day string, k int, v string")

    tables.append(frame(("d1", 1, "a"), ("d2", 2, "b")), name)
    tables.append(frame(("d2", 3, "c")), name)
    assert rows(spark.table(name)) == [(1, "a", "d1"), (2, "b", "d2"), (3, "c", "d2")]
    tables.publish_partitions(frame(("d2", 9, "z"), ("d3", 4, "n")), name, "day")
    assert rows(spark.table(name)) == [(1, "a", "d1"), (4, "n", "d3"), (9, "z", "d2")]
    # a partition may be replaced from itself
    again = tables.touched(spark.table(name), frame(("d2", 0, "x")), "day").withColumn("k", F.col("k") + 1)
    tables.publish_partitions(again, name, "day")
    assert rows(spark.table(name)) == [(1, "a", "d1"), (10, "z", "d2"), (4, "n", "d3")]
    by_join = tables.touched(spark.table(name), frame(("d1", 0, ""), ("d3", 0, "")), "day")
    assert rows(by_join, "k") == [(1,), (4,)]
    tables.register_partitions(spark, name)
    tables.publish_snapshot(frame(("d7", 7, "s")), name)
    assert rows(spark.table(name)) == [(7, "s", "d7")]
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_touched_partitions_prune(spark, layers):
    name = f"{layers.silver}.p"
    tables.create_table(spark, name, {"k": "int", "day": "date"}, "day", location=layers.location)
    df = spark.range(10).selectExpr("cast(id as int) k", "date_add(date'2024-01-01', cast(id as int)) day")
    tables.append(df, name)
    part = tables.touched(spark.table(name), df.where("k < 2"), "day")
    assert part.count() == 2
    assert "PartitionFilters: [isnotnull(day" in part._jdf.queryExecution().executedPlan().toString()


def test_quality(spark):
    df = spark.createDataFrame(
        [("a", 5.0, "2024-01-30"), ("a", 105.0, "2023-11-01"), ("b", float("nan"), "30/01/2024"), (None, None, None)],
        "k string, x double, d string",
    )
    checks = {"x": outside_range("x", 0, 100), "k": outside_domain("k", ["a"]), "d": not_recent("d", "2024-02-01 12:00:00")}
    report = {r["check"]: r["violations"] for r in row_report(df, checks).collect()}
    assert report == {"x": 2, "k": 2, "d": 3, "not_empty": 0}
    batch = {r["check"]: r["violations"] for r in quality_report(df, ["k"]).collect()}
    assert batch == {"k_present": 1, "not_empty": 0, "unique_keys": 1}
    empty = {r["check"]: r["violations"] for r in quality_report(df.where("false"), ["k"]).collect()}
    assert empty["not_empty"] == 1


def test_manifests(spark):
    good = {"status": "SUCCESS", "lambda_exec_ts": "t", "domain": "d", "source": "s", "dataset": "x", "keys": ["k"], "record_count": 3, "ingested_at": "t"}
    cases = [
        (json.dumps(good), None),
        (json.dumps(good | {"status": "FAILED"}), "not successful"),
        (json.dumps(good | {"record_count": 0}), "no records"),
        (json.dumps({k: v for k, v in good.items() if k != "keys"}), "missing field"),
        ("oops", "not json"),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, manifest string")
    assert rows(manifest_gate(df), "i", "problem") == [(i, c[1]) for i, c in enumerate(cases)]
    announced = spark.createDataFrame([("a", 2), ("b", 1)], "g string, record_count long")
    found = spark.createDataFrame([("a",), ("a",), ("c",)], "g string")
    assert rows(manifest_reconcile(announced, found, ["g"])) == [("a", 2, 2, 0), ("b", 1, 0, -1), ("c", 0, 1, 1)]


def test_article_arguments(spark):
    df = spark.createDataFrame([("https://x.org/1", "The Copper", None, "2024-01-01")], "article_url string, title string, description string, published_at string")
    df = df.withColumn("published_at", F.col("published_at").cast("timestamp"))
    assert article_search(df, ["copper"]).count() == 1
    assert article_search(df, ["copper", "india"]).count() == 0
    assert article_search(df, ["copper"], search_in=["description"]).count() == 0
    assert article_search(df, ["copper"], domains=["x.org"], page=2).count() == 0
    with pytest.raises(ValueError):
        article_search(df, [])
    with pytest.raises(ValueError):
        article_search(df, ["a"], sort_by="random")
    with pytest.raises(ValueError):
        default_rollup(df, {"title": "median"}, ["article_url"])


def test_shared_folder_follows_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == before or before is None


def test_lists_of_objects_are_rows_in_both_modes(spark, tmp_path):
    key = lines(tmp_path / "x.jsonl", [{"a": 1}, {"a": 2}], {"a": 3}, [])
    assert rows(scan_bronze(spark, [key], ["a"])) == [("1",), ("2",), ("3",)]
    good, bad = split_corrupt(scan_bronze(spark, [key], ["a"], "PERMISSIVE"))
    assert rows(good) == [("1",), ("2",), ("3",)] and bad.count() == 0


def test_member_names(spark, tmp_path):
    from stratalake.operators.quality import missing_columns

    key = lines(tmp_path / "x.jsonl", {"a": None, "b": 1}, {"b": 2})
    read = scan_bronze(spark, [key], ["a", "b", "c"], members=True)
    assert missing_columns(read, ["a", "b", "c"], "_members") == (2, ["c"])
    assert missing_columns(read.drop("c"), ["a", "c"]) == (2, ["c"])


def test_publishing_from_two_threads(spark, layers):
    """Static and dynamic overwrites at the same time don't mix."""
    from concurrent.futures import ThreadPoolExecutor

    for t in ("s", "d"):
        tables.create_table(spark, f"{layers.silver}.{t}", {"k": "int", "day": "string"}, "day", location=layers.location)
        tables.append(spark.range(4).selectExpr("cast(id as int) k", "cast(id as string) day"), f"{layers.silver}.{t}", "day")
    one = spark.createDataFrame([(9, "1")], "k int, day string")
    with ThreadPoolExecutor(4) as pool:
        jobs = []
        for _ in range(3):
            jobs.append(pool.submit(tables.publish_partitions, one, f"{layers.silver}.d", "day"))
            jobs.append(pool.submit(tables.publish_snapshot, one, f"{layers.silver}.s", "day"))
        for job in jobs:
            job.result()
    assert rows(spark.table(f"{layers.silver}.d")) == [(0, "0"), (2, "2"), (3, "3"), (9, "1")]
    assert rows(spark.table(f"{layers.silver}.s")) == [(9, "1")]
    tables.drop_partitions(spark, f"{layers.silver}.d", "day", ["0", "no such"])
    assert spark.table(f"{layers.silver}.d").count() == 3


def test_ties_of_the_latest_rows(spark):
    from stratalake.operators.reports import most_recent

    df = spark.createDataFrame([("A", "d1", i) for i in range(9)], "symbol string, trade_date string, v int")
    assert [r["v"] for r in most_recent(df.repartition(5), "A", ["v"], 3).collect()] == [0, 1, 2]


@pytest.mark.parametrize("sort_by", ["publishedAt", "title"])
def test_pages_by_the_last_article_seen(spark, sort_by):
    """All pages one after another, with ties and unknown times and titles, are the whole list in order."""
    data = [(f"https://x.org/{n:02}", None if n % 7 == 0 else f"copper {n % 4}", "copper", None if n % 5 == 0 else f"2024-01-0{n % 3 + 1}") for n in range(40)]
    df = spark.createDataFrame(data, "article_url string, title string, description string, published_at string")
    df = df.withColumn("published_at", F.col("published_at").cast("timestamp"))
    whole = article_search(df, ["copper"], sort_by=sort_by, page_size=100).collect()
    seen, after = [], None
    while page := article_search(df, ["copper"], sort_by=sort_by, page_size=6, after=after).collect():
        seen += page
        after = (page[-1]["published_at" if sort_by == "publishedAt" else "title"], page[-1]["article_url"])
    assert seen == whole and len(whole) == 40
    with pytest.raises(ValueError):
        article_search(df, ["copper"], page=2, after=("x", "y"))


def test_raw_zone_is_written_without_sorting(spark, tmp_path, monkeypatch):
    """Rows stream into the folders of a zone, also into more than a task keeps open; the settings for that don't stay."""
    limits = ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before, during = [spark.conf.get(k) for k in limits], []
    json = DataFrameWriter.json

    def written(self, *args, **options):
        during.extend(spark.conf.get(k) for k in limits)
        return json(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "json", written)
    df = spark.range(100).select("id", F.lit("s").alias("source"), F.concat(F.lit("d"), (F.col("id") % 40).cast("string")).alias("dataset"))
    write_raw_zone(df, str(tmp_path / "zone"), "2024-02-01T00:00:00+00:00")
    assert int(during[0]) > 0 and during[1] != before[1]
    assert [spark.conf.get(k) for k in limits] == before
    back = spark.read.json(str(tmp_path / "zone")).groupBy("dataset").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))
    assert (back.count(), back.agg(F.sum("n"), F.sum("ids")).first()) == (40, (100, 4950))
