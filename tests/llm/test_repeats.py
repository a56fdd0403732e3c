"""Repeated phrases against every window of every document."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratalake.llm import repeats, words
from stratalake.llm.queries import QUERIES

from .brute import removed_words
from .conftest import SMALL


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows, window=50, phrase=8, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeats.find(docs, window, phrase, **options)
    expected = sorted(
        (str(doc_id), len(w), sum(gone), digest(" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
        for (doc_id, _), (w, gone) in zip(rows, removed_words(rows, window), strict=True)
    )
    actual = got.collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in actual) == expected
    assert all(sum(r["ends"]) - sum(r["begins"]) == r["n_removed"] for r in actual)
    return docs, got


def made(seed, n=60, vocabulary=400):
    """Documents from few words, with copies, shared passages at odd places, and loops."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    passages = [[word() for _ in range(rng.choice([49, 50, 51, 60, 130]))] for _ in range(6)]
    rows = []
    for i in range(n):
        text = [word() for _ in range(rng.choice([0, 3, 40, 200]))]
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice(passages)
        if rng.random() < 0.1:
            text += ["loop", "de"] * rng.randrange(80)
        rows.append((rng.randrange(10_000) * 10 + i % 10, " ".join(text) if rng.random() < 0.8 else "\n ".join(text)))
        if rng.random() < 0.2:
            rows.append((rng.randrange(100_000) * 10 + 5, rows[rng.randrange(len(rows))][1]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_made_documents(spark, seed):
    check(spark, made(seed), bucket_bytes=5000)


def test_short_windows(spark):
    check(spark, made(3, n=40, vocabulary=12), window=10, phrase=4, bucket_bytes=2000)


def test_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    long = " ".join(f"x{i}" for i in range(70))
    rows += [(None, long), (7000, long), (7000, long), (7001, long + " end"), (7000, "other " + long)]
    docs, got = check(spark, rows)
    kept = {r["doc_id"]: r["text"] for r in repeats.remove(docs, got).where("doc_id >= 7000").collect()}
    assert kept == {7000: kept[7000], 7001: "end"}


def test_remove(spark):
    rows = made(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeats.remove(docs, repeats.find(docs)).collect()
    expected = []
    for (doc_id, text), (w, gone) in zip(rows, removed_words(rows), strict=True):
        if not any(gone):
            expected.append((doc_id, text))
        elif not all(gone):
            expected.append((doc_id, " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    assert sorted(map(tuple, got)) == sorted(expected)


def test_empty_table(empty):
    found = repeats.find(empty)
    assert found.count() == 0 and repeats.remove(empty, found).count() == 0


def test_query(spark, documents):
    rows = list(zip(documents["doc_id"].to_pylist(), documents["text"].to_pylist(), strict=True))
    expected = {(d, len(w), sum(g), digest(" ".join(x for x, y in zip(w, g, strict=True) if not y))) for (d, _), (w, g) in zip(rows, removed_words(rows), strict=True)}
    assert {tuple(r) for r in QUERIES["op3_repeated_phrases"](spark, SMALL).collect()} == expected
    assert sum(x[2] for x in expected) > 0


@given(st.lists(st.integers(0, 5), max_size=60), st.integers(1, 5), st.integers(0, 10))
def test_anchor_is_the_smallest_phrase(values, phrase, more):
    hashes = words.mix(np.array(values, dtype=np.uint64))
    window = phrase + more
    grams = words.gram_hashes(hashes, phrase)
    expected = [int(grams[s : s + more + 1].min()) for s in range(len(values) - window + 1)]
    assert repeats.anchors(hashes, window, phrase).tolist() == expected


def test_automaton_finds_blocks():
    codes = [np.array([1, 2, 3, 4, 5], dtype=np.uint32), np.array([3, 4], dtype=np.uint32)]
    found = [e for e, _ in repeats.compile_automaton(codes, 2).iter((9, 1, 2, 3, 4, 2, 3))]
    assert found == [2, 4]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB \n\té \u0085", max_size=30)), max_size=6), st.booleans())
def test_words(texts, lower):
    from .brute import LOWER, WORD

    found = words.words_of(pa.array(texts, pa.string()), lower)
    for i, text in enumerate(texts):
        text = (text or "").translate(LOWER) if lower else text or ""
        lo, hi = int(found.first[i]), int(found.first[i + 1])
        assert found.joined(lo, hi).decode() == " ".join(WORD.findall(text))
        keep = list(range(lo, hi))[::2]
        assert words.joined(found.data, found.begin[keep], found.end[keep]).decode() == " ".join(WORD.findall(text)[::2])
    by_word = {}
    for b, e, h in zip(found.begin, found.end, found.hash, strict=True):
        assert by_word.setdefault(found.data[b:e].tobytes(), h) == h
    assert len(set(by_word.values())) == len(by_word)
