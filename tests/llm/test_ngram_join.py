"""The n-gram join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from stratalake.llm import components, ngram_join
from stratalake.llm.queries import QUERIES
from stratalake.llm.store import SLICE_BYTES
from stratalake.session import Scratch

from .brute import Union, jaccard_components, shingles
from .conftest import SMALL


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted((str(d), size, str(c)) for (d, _), (size, c) in zip(rows, jaccard_components(rows), strict=True))
    got = ngram_join.join(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == expected
    return expected


def made(seed, groups=12, copies=25):
    """Groups of near copies around the threshold, exact copies, a common passage, short texts."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    common = [word() for _ in range(40)]
    rows, ids = [], rng.sample(range(100_000), groups * copies + 100)
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([6, 12, 60, 150]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(max(1, len(own) // 15) + 1)):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.3:
                own += common
            if rng.random() < 0.3:
                own = own[: rng.randrange(len(own) // 2, len(own) + 1)]
            rows.append((ids.pop(), " ".join(own).upper() if rng.random() < 0.1 else " ".join(own)))
            if rng.random() < 0.2:
                rows.append((ids.pop() if ids else 5, rows[-1][1]))
    return rows + [(ids.pop(), " ".join(common)) for _ in range(3)]


@pytest.mark.parametrize("seed", [1, 2])
def test_made_documents(spark, seed):
    found = check(spark, made(seed))
    assert len({c for _, _, c in found}) < len(found)


def test_one_large_group(spark):
    check(spark, made(5, groups=1, copies=400))


def test_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows += [(50, "a"), (51, "A"), (52, "a b c d"), (53, "a B\nc d"), (54, "a b c d e"), (55, "one two three four five six SEVEN"), (None, "a")]
    check(spark, rows)


def test_one_id_with_two_texts_is_one_node(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "p q r s t u"), (3, "p q r s t u"), (4, "z z z z z z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in ngram_join.join(docs).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_empty_table(empty):
    assert ngram_join.join(empty).count() == 0


def test_query(spark, documents):
    rows = list(zip(documents["doc_id"].to_pylist(), documents["text"].to_pylist(), strict=True))
    expected = {(d, size, c) for (d, _), (size, c) in zip(rows, jaccard_components(rows), strict=True)}
    assert {tuple(r) for r in QUERIES["op9_ngram_jaccard"](spark, SMALL).collect()} == expected


def test_sets():
    texts = ["a b c d e f", None, "", "x", "X", "a b c d e a b c d e a b c d e", "q w e r"]
    grams, counts = ngram_join.sets_of(pa.array(texts, pa.string()))
    assert counts.tolist() == [len(shingles(t)) for t in texts]
    parts = np.split(grams, np.cumsum(counts)[:-1])
    assert parts[3].tolist() == parts[4].tolist() and all((np.diff(p) > 0).all() if len(p) > 1 else True for p in parts)


@pytest.mark.parametrize("threshold", [60, 75, 100])
def test_bounds_are_exact(threshold):
    a, b = (x.ravel() for x in np.meshgrid(np.arange(1, 60), np.arange(1, 60)))
    least = ngram_join.needed(a, b, threshold)
    assert (100 * least >= threshold * (a + b - least)).all() and (100 * (least - 1) < threshold * (a + b - least + 1)).all()


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    with Scratch(spark, "test") as scratch:
        got = components.components(spark.createDataFrame([*edges, (None, 1)], "a long, b long"), scratch)
        assert {(r["node"], r["component"]) for r in got.collect()} == {(x, union.find(x)) for e in edges for x in e}
        assert components.components(spark.createDataFrame([], "a long, b long"), scratch).count() == 0


def test_python_gets_small_batches(spark, monkeypatch):
    """While documents are joined, a batch of texts is bounded by its bytes; afterwards the setting is as before."""
    key, during, join = "spark.sql.execution.arrow.maxBytesPerBatch", [], ngram_join._join
    before = spark.conf.get(key)
    monkeypatch.setattr(ngram_join, "_join", lambda *a: during.append(spark.conf.get(key)) or join(*a))
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.join(docs).collect()}
    assert (found, during) == ({1: 1, 2: 1, 3: 3}, [str(SLICE_BYTES)])
    assert spark.conf.get(key) == before
