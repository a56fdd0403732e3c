"""The quality classifier: features and scores against plain Python, held-out quality, odd rows."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import language, words
from stratalake.llm import quality_model as Q
from stratalake.llm.queries import QUERIES

from .conftest import ODD_TEXTS

LARGER = "/root/testdata/sf0.1"
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[!-/:-@\[-`{-~]+")


def plain_features(text, bits):
    """Coordinate -> value of one text; hashes of words and of pairs as the library has them."""
    found = WORD.findall((text or "").encode())
    if not found:
        return {}
    data = np.frombuffer(b"".join(found), dtype=np.uint8)
    end = np.cumsum([len(w) for w in found])
    hashes = words._word_hashes(data, end - [len(w) for w in found], end)
    counts = Counter((np.concatenate([hashes, words.gram_hashes(hashes, 2)]) & np.uint64((1 << bits) - 1)).tolist())
    values = {k: 1 + math.log(n) for k, n in counts.items()}
    length = math.sqrt(sum(v * v for v in values.values()))
    return {k: v / length for k, v in values.items()}


@pytest.mark.parametrize("bits", [6, 18])
def test_features(bits):
    texts = [*ODD_TEXTS, "A | B | C!!", "tail###", "\x00a\x7fb"]
    first, at, value = Q.features(pa.array(texts, pa.string()), bits)
    for i, text in enumerate(texts):
        got = dict(zip(at[first[i] : first[i + 1]].tolist(), value[first[i] : first[i + 1]].tolist(), strict=True))
        assert got == pytest.approx(plain_features(text, bits))
    assert len(Q.features(pa.array([], pa.string()), bits)[1]) == 0


def test_updates_follow_the_formulas():
    """Per coordinate: w from (z, n), then z and n from the slope."""
    rng = np.random.default_rng(3)
    leader = Q.Leader(np.zeros((2, 9)), alpha=0.7, beta=1.0, l1=0.05, l2=0.1)
    z, n = [0.0] * 9, [0.0] * 9

    def weight(i):
        return 0.0 if abs(z[i]) <= 0.05 else (math.copysign(0.05, z[i]) - z[i]) / ((1.0 + math.sqrt(n[i])) / 0.7 + 0.1)

    for _ in range(60):
        at = rng.choice(8, 3, replace=False)
        value, label = rng.normal(size=3), int(rng.integers(0, 2))
        leader.learn(at, value, label)
        x = [*zip(at.tolist(), value.tolist(), strict=True), (8, 1.0)]
        before = {i: weight(i) for i, _ in x}
        p = 1 / (1 + math.exp(-sum(before[i] * v for i, v in x)))
        for i, v in x:
            g = (p - label) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.7 * before[i]
            n[i] += g * g
    assert np.allclose(leader.z, z) and np.allclose(leader.weights(), [weight(i) for i in range(9)])


def test_query(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op12_quality_classifier"](spark, LARGER).collect()}
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in rows.items())
    told = [(rows[r["doc_id"]], r["quality"]) for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect() if r["doc_id"] in rows]
    good = np.array([r["score"] for r, q in told if r["held_out"] and q == 1])
    bad = np.array([r["score"] for r, q in told if r["held_out"] and q == 0])
    assert (good[:, None] > bad).mean() >= 0.99
    assert (good >= 0.3).mean() >= 0.99 and (bad >= 0.3).mean() <= 0.25


@pytest.fixture(scope="module")
def labelled(spark):
    """Texts whose label shows in their words; ids, languages and sources tell nothing."""
    docs = [(i, " ".join(f"{'good' if i % 3 else 'bad'}{(i * k) % 7}" for k in range(1, 12)), "en", 0.5) for i in range(300)]
    labels = [(i, int(i % 3 > 0), 5) for i in range(300)]
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, score double"), spark.createDataFrame(labels, "doc_id long, quality int, lang int")


def test_held_out_labels_and_other_columns_teach_nothing(spark, labelled):
    docs, labels = labelled
    seen = labels.where(~language.held_out())
    weights = Q.train(docs, seen, bits=10)
    spoiled = labels.withColumn("quality", F.when(language.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(weights, Q.train(docs.repartition(7).withColumn("lang", F.lit("x")), spoiled.where(~language.held_out()).repartition(5), bits=10))
    out = {r["doc_id"]: r for r in Q.score(docs, weights).collect()}
    assert all((r["score"] > 0.5) == bool(i % 3) for i, r in out.items())
    assert set(out[0].asDict()) == set(docs.columns)
    # a score is the logistic function of the plain dot product
    x = plain_features(out[5]["text"], 10)
    assert out[5]["score"] == pytest.approx(1 / (1 + math.exp(-sum(weights[k] * v for k, v in x.items()) - weights[-1])), rel=1e-4)


def test_sample_is_bounded_and_not_by_partitions(spark, labelled):
    docs, labels = labelled
    few = Q.train(docs, labels, bits=8, sample=20, rounds=1, shards=2)
    assert np.array_equal(few, Q.train(docs.repartition(3), labels.repartition(9), bits=8, sample=20, rounds=1, shards=2))
    assert not np.array_equal(few, Q.train(docs, labels, bits=8, sample=21, rounds=1, shards=2))


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(12)] + [(None, 1, 1), (3, 0, 1), (3, None, 1), (99, 1, 1), (99, 1, 1)], "doc_id long, quality int, text string")
    weights = Q.train(odd, labels, bits=8)
    rows = Q.score(odd, weights).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if not (r["text"] or "").strip()}
    assert len(empty) == 1 and empty.pop() == pytest.approx(float(Q.logistic(weights[-1])))
    assert Q.score(odd.limit(0), weights).count() == 0
    none = Q.train(odd, labels.where("quality > 5"), bits=8)
    assert {r["score"] for r in Q.score(odd, none, carry=["doc_id"]).collect()} == {0.5}
    assert np.array_equal(none, Q.train(odd.limit(0), labels, bits=8))
