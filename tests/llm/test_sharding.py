"""Shards: sizes, whole groups, gapless slots, and no Python in the plan."""

from __future__ import annotations

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stratalake.llm import sharding
from stratalake.llm.queries import QUERIES

from .conftest import SMALL


def placed(docs, shards=16, **options):
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    return sharding.shard(docs, shards, size, F.xxhash64("text"), F.col("doc_id"), **options)


def check(rows, shards, size):
    """Every row once, gapless slots; returns the bytes of each shard and the shards of each text."""
    by, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        by[r["shard"]].append(r)
        groups[r["text"]].add(r["shard"])
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return [sum(map(size, by[s])) for s in range(shards)], groups


def weight(r):
    return len((r["text"] or "").encode()) + 1


def test_query(spark, documents):
    rows = QUERIES["op7_sampled_splitters"](spark, SMALL).collect()
    texts = dict(zip(documents["doc_id"].to_pylist(), documents["text"].to_pylist(), strict=True))
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    sizes, groups = check([r.asDict() | {"text": texts[r["doc_id"]]} for r in rows], 16, weight)
    assert max(sizes) <= 1.02 * min(sizes) and max(map(len, groups.values())) == 1


@pytest.mark.parametrize("share", [0.1, 0.6])
def test_hot_group(spark, share):
    """A group that fits into half a shard stays whole; a larger one is spread, and sizes stay equal."""
    n = 4000
    hot = int(n * share * (0.3 if share < 0.2 else 1))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") < hot, F.lit("the same text")).otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"))
    rows = placed(docs, 8).collect()
    sizes, groups = check(rows, 8, weight)
    assert len(rows) == n and max(sizes) <= 1.03 * min(sizes)
    assert (len(groups["the same text"]) == 1) == (share < 0.2)
    assert sum(len(g) > 1 for g in groups.values()) == (share > 0.2)


def test_uneven_sizes(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('x', cast(case when id % 100 = 0 then 20000 else id % 50 end as int)) || id").alias("text"))
    sizes, _ = check(placed(docs, 4).collect(), 4, weight)
    assert max(sizes) <= 1.03 * min(sizes)


def test_odd_rows(spark, odd):
    """Columns with clashing names are replaced or kept, null ids and texts are placed."""
    out = placed(odd, 4)
    assert out.columns == [c for c in odd.columns if c != "shard"] + ["shard", "slot"]
    rows = out.collect()
    check(rows, 4, weight)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in odd.collect())
    assert placed(odd.limit(0)).count() == 0
    one = placed(odd, 1).collect()
    assert {r["shard"] for r in one} == {0} and sorted(r["slot"] for r in one) == list(range(len(one)))


def test_native(spark):
    plan = placed(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_splitters_follow_the_weight(spark):
    """A tenth of the keys has nine tenths of the bytes, and so most of the splitters."""
    sizes = spark.range(20_000).select(F.col("id").alias("key"), F.col("id").alias("tie"), F.expr("case when id < 2000 then 81 else 1 end").alias("size"))
    found = sharding.splitters(sizes, 180_000, 100)
    assert len(found) > 90 and 0.8 < sum(x < 2000 for x in found) / len(found) <= 0.98
    assert sharding.splitters(sizes, 0, 100) == [] and sharding.splitters(sizes, 180_000, 1) == []


def test_range_of(spark):
    for bounds in ([], [5], [2, 4, 9], list(range(0, 100, 7))):
        got = spark.range(-5, 110).select("id", sharding._range_of(bounds, "id").alias("r")).collect()
        assert all(r["r"] == sum(b <= r["id"] for b in bounds) for r in got)
