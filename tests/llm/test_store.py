"""Wide rows that have no partner in a small table stay where they are."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from stratalake.llm import repeats, store
from stratalake.session import settings

#: Joins are planned as for large tables, in plans whose figures can be read.
AS_LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}


def shuffled(df) -> int:
    """Rows that ``df`` shuffles when its rows are collected."""
    df.collect()

    def of(node) -> int:
        found = node.metrics().get("shuffleRecordsWritten")
        below = node.children()
        return (found.get().value() if found.isDefined() else 0) + sum(of(below.apply(i)) for i in range(below.size()))

    return of(df._jdf.queryExecution().executedPlan())


def texts(spark):
    """600 documents, of which 10 repeat a passage and 10 are near copies."""
    rng = random.Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows = [(i, text(80)) for i in range(580)]
    rows += [(580 + i, f"{text(20)} {rows[i][1]} {text(20)}") for i in range(10)]
    rows += [(590 + i, rows[100 + i][1] + " end") for i in range(10)]
    return spark.createDataFrame([*rows, (None, rows[0][1])], "doc_id long, text string")


@pytest.mark.parametrize("size", [1, 1 << 17])
def test_split_few(spark, monkeypatch, size):
    """Also with a bitmap that is full."""
    monkeypatch.setattr(store, "BITMAP_WORDS", size)
    rows = spark.createDataFrame([(i if i else None, f"t{i}") for i in range(500)] + [(7, "t7"), (7, "t7")], "id long, text string")
    few = spark.createDataFrame([(i * 3, i) for i in range(1, 101)] + [(None, 0), (10**9, 0)], "id long, n int")
    may, none = store.split_few(rows, few, ["id"])
    assert may.columns == none.columns == rows.columns
    some, others = may.collect(), none.collect()
    assert sorted(r["text"] for r in [*some, *others]) == sorted(r["text"] for r in rows.collect())
    assert {3 * i for i in range(1, 101)} <= {r["id"] for r in some}
    assert size == 1 or len(some) < 150
    assert sorted(r["n"] for r in store.join_few(rows, few, ["id"]).collect()) == list(range(1, 101))
    nothing = store.split_few(rows, few.limit(0), ["id"])
    assert (nothing[0].count(), nothing[1].count()) == (0, 502)


def test_near_duplicates_shuffles_few_texts(spark):
    docs = texts(spark)
    with settings(spark, AS_LARGE):
        kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
        assert shuffled(kept) < 200
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted([*map(str, range(590)), "None"])


def test_remove_shuffles_few_texts(spark):
    docs = texts(spark)
    found = repeats.find(docs)
    assert found.where("n_removed > 0").count() == 20
    with settings(spark, AS_LARGE):
        kept = repeats.remove(docs, found)
        assert shuffled(kept) < 200
        lengths = {r["doc_id"]: len(r["text"].split()) for r in kept.collect()}
    assert lengths == {**dict.fromkeys([None, *range(580)], 80), **dict.fromkeys(range(580, 590), 40), **dict.fromkeys(range(590, 600), 1)}


def test_stages_bound_batches(spark):
    """Also of results that are read after the stage returned."""
    key = next(iter(store.SMALL_BATCHES))
    docs = spark.createDataFrame([(i, "x" * (1 << 20)) for i in range(9)], "doc_id long, text string").coalesce(1)
    with settings(spark, {key: "64m"}):
        spark.conf.unset(key)
        corpus_pipeline.pack_windows(spark, docs, "")

        def sizes(batches):
            for b in batches:
                yield b.select(["doc_id"]).slice(0, 1)

        assert docs.mapInArrow(sizes, "doc_id long").count() > 1
    with settings(spark, {key: "5m"}):
        corpus_pipeline.pack_windows(spark, docs, "")
        assert spark.conf.get(key) == "5m"
