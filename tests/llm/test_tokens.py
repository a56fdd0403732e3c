"""Packing and the token file against the library, text by text."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratalake.llm import packing, token_file
from stratalake.llm.chunks import byte_pair, cut
from stratalake.llm.queries import QUERIES
from stratalake.session import scratch_path

from .conftest import SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab,'s \n\t\ré 　×-1|<>endoftx\u0085日", max_size=40), max_size=5))
def test_chunks_give_the_librarys_ids(texts):
    import pyarrow as pa

    ids, counts = byte_pair(PATH).encode(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts))[:-1]] == [ids_of(t) for t in texts]


def test_cut_borders():
    data = np.frombuffer(b"ab cd", dtype=np.uint8)
    begin, end, text = cut(data, np.array([0, 2, 2, 5]))
    assert begin.tolist() == [0, 2] and end.tolist() == [2, 5] and text.tolist() == [0, 2]


def check_pieces(rows, expected, capacity, end_id):
    """Every id of every document lies in exactly one piece; sequences are gapless and full but few."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
    for doc_id, texts in expected.items():
        wanted = sorted([*t, end_id] for t in texts)
        pieces = sorted(by_doc.pop(doc_id), key=lambda r: r["start"])
        if len(texts) == 1:
            got = [i for r in pieces for i in np.frombuffer(r["ids"], "<u4").tolist()]
            assert got == wanted[0] and {r["doc_tokens"] for r in pieces} == {len(got)}
            assert [r["start"] for r in pieces] == np.cumsum([0, *(r["length"] for r in pieces)])[:-1].tolist()
        else:
            assert sum(r["length"] for r in pieces) == sum(map(len, wanted))
    assert not by_doc
    return by_sequence


def test_pack_odd_rows(spark, odd):
    expected = defaultdict(list)
    for r in odd.collect():
        expected[r["doc_id"]].append(ids_of(r["text"]))
    rows = packing.pack(odd.coalesce(1), PATH, capacity=32).collect()
    sequences = check_pieces(rows, expected, 32, 1)
    assert sum(sum(r["length"] for r in x) < 32 for x in sequences.values()) <= 1


def test_pack_empty_table(empty):
    assert packing.pack(empty, PATH).count() == 0


def test_pack_whole_table(spark, documents):
    expected = {d: [ids_of(t)] for d, t in zip(documents["doc_id"].to_pylist(), documents["text"].to_pylist(), strict=True)}
    pieces = packing.pack(spark.read.parquet(f"{SMALL}/documents.parquet"), PATH)
    sequences = check_pieces(pieces.collect(), expected, 2048, 1)
    padded = sum(2048 - sum(r["length"] for r in x) for x in sequences.values())
    assert padded < 2048 * pieces.rdd.getNumPartitions()
    whole = packing.sequences(pieces).collect()
    assert all(len(r["ids"]) == 4 * r["length"] for r in whole) and len(whole) == len(sequences)


def test_query_digests(spark):
    rows = QUERIES["op1_sum_of_squares_packing"](spark, SMALL).collect()
    pieces = packing.pack(spark.read.parquet(f"{SMALL}/documents.parquet"), PATH).collect()
    assert {(r["doc_id"], r["start"], r["ids_crc32"]) for r in rows} == {(r["doc_id"], r["start"], zlib.crc32(r["ids"])) for r in pieces}


@given(st.lists(st.integers(1, 9), min_size=1, max_size=60))
def test_level_minimises_the_sum_of_squares(sizes):
    packer = packing.Packer(10)
    for i, size in enumerate(sizes):
        before = packer.counts.copy()
        level = packer.level_for(size)

        def after(h, size=size, n=before):
            n = n.copy()
            n[h] -= h > 0
            n[h + size] += h + size < 10
            return int((n[1:10] ** 2).sum())

        choices = [h for h in range(0, 11 - size) if h == 0 or before[h] > 0]
        assert level in choices and after(level) == min(map(after, choices))
        packer.add(i, np.arange(size, dtype=np.uint32))
        assert packer.n_open == packer.counts.sum() == sum(map(len, packer.open))
    total = sum(w.fill for w in packer.closed) + sum(w.fill for x in packer.open for w in x)
    packer.flush()
    assert total == sum(w.fill for w in packer.closed) == sum(sizes)
    assert sum(w.fill < 10 for w in packer.closed) <= 1


def test_flush_bounds_open_windows():
    packer = packing.Packer(100, most_open=5)
    for i in range(200):
        packer.add(i, np.arange(51 + i % 40, dtype=np.uint32))
        assert packer.n_open <= 5


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1500), st.randoms())
def test_codes_round_trip(values, random):
    codes = token_file.Codes(token_file.encode(np.array(values, dtype=np.uint32)))
    assert codes.all().tolist() == values
    if values:
        places = [random.randrange(len(values)) for _ in range(50)]
        assert codes.at(np.array(places)).tolist() == [values[p] for p in places]
    with pytest.raises(IndexError):
        codes.at(np.array([len(values)]))


def test_token_file_odd_rows(spark, odd):
    path = scratch_path(spark, "test")
    token_file.write(odd, path, PATH, segment_tokens=16)
    got = sorted(((r["start"], r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_file.read(spark, path).collect()))
    assert [r[1] for r in got] == sorted((r["doc_id"] for r in odd.collect()), key=lambda x: (x is not None, x or 0))
    assert [r[0] for r in got] == np.cumsum([0, *(len(r[2]) for r in got)])[:-1].tolist()
    expected = sorted([*ids_of(r["text"]), 2] for r in odd.collect())
    assert sorted(r[2] for r in got) == expected
    flat = [i for r in got for i in r[2]]
    places = spark.createDataFrame([(p,) for p in [0, 5, len(flat) - 1, len(flat), 17, 17]], "place long")
    answers = token_file.tokens_at(spark, path, places).collect()
    assert sorted((r["place"], r["id"]) for r in answers) == sorted((p, flat[p]) for p in [0, 5, len(flat) - 1, 17, 17])


def test_token_file_empty_table(spark, empty):
    path = scratch_path(spark, "test")
    token_file.write(empty, path, PATH)
    assert token_file.read(spark, path).count() == 0


def test_token_file_query(spark, documents):
    rows = QUERIES["op5_token_file"](spark, SMALL).collect()
    at, expected = 0, set()
    for doc_id, text in zip(documents["doc_id"].to_pylist(), documents["text"].to_pylist(), strict=True):
        ids = [*ids_of(text), 2]
        expected.add((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected)
