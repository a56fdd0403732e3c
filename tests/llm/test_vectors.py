"""Nearest neighbours and near-duplicate vectors against exhaustive search."""

from __future__ import annotations

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratalake.llm import neighbours, similar_vectors
from stratalake.llm.queries import ORACLE, QUERIES

from .brute import Union
from .conftest import SMALL

ODD = [
    (None, [1.0, 0.0, 2.0]),
    (1, None),
    (2, []),
    (3, [0.0, 0.0, 0.0]),
    (4, [1.0, None, 2.0]),
    (5, [1.0, float("nan"), 2.0]),
    (6, [float("inf"), 1.0, 2.0]),
    (7, [1.0, 2.0]),
    (8, [1.0, 2.0, 3.0]),
    (9, [1.0, 2.0, 3.0]),
    (9, [1.0, 2.0, 3.0]),
    (10, [2.0, 4.0, 6.1]),
    (11, [-1.0, 2.0, 0.5]),
    (12, [1e-3, 2e-3, 3e-3]),
]


@pytest.fixture(scope="module")
def odd_vectors(spark):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in ODD], "vec_id long, embedding array<float>, label string, rank int")


def table(spark, rows, ids=None):
    ids = range(len(rows)) if ids is None else ids
    return spark.createDataFrame(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(list(rows), pa.list_(pa.float32()))}))


def exact(x, ids, query, k):
    score = sum(x[:, d].astype(float) * float(query[1][d]) for d in range(x.shape[1]))
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != query[0]][:k]
    return [(int(ids[i]), float(score[i])) for i in order]


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r)
    return out


def test_search_with_all_bits_is_exact(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 9)).astype(np.float32) * rng.uniform(0.1, 3, (300, 1)).astype(np.float32)
    x[50:60] = x[49]
    rows = table(spark, x)
    got = by_query(neighbours.search(rows, rows.where("vec_id % 20 = 0"), k=7, radius=128, block_rows=64, block_queries=4))
    assert sorted(got) == list(range(0, 300, 20))
    for q, found in got.items():
        assert [(r["vec_id"], r["score"]) for r in found] == exact(x, np.arange(300), (q, x[q]), 7)
        assert [r["rank"] for r in found] == list(range(1, 8))


@pytest.mark.parametrize("spread", [0.1, 1.0, 30.0])
def test_recall(spark, spread):
    """Clustered and even directions, lengths that differ: nine tenths of the nearest are found."""
    rng = np.random.default_rng(2)
    x = (rng.standard_normal((40, 64))[rng.integers(0, 40, 6000)] + spread * rng.standard_normal((6000, 64))) * rng.uniform(0.5, 1, (6000, 1))
    x = x.astype(np.float32)
    rows = table(spark, x)
    got = by_query(neighbours.search(rows, rows.where("vec_id % 100 = 0"), k=20, block_rows=2000))
    hits = sum(len({r["vec_id"] for r in found} & {i for i, _ in exact(x, np.arange(6000), (q, x[q]), 20)}) for q, found in got.items())
    assert len(got) == 60 and hits >= 0.9 * 20 * 60


def test_probes_find_every_code_within_the_radius():
    rng = np.random.default_rng(3)
    own = rng.integers(0, 256, (400, 4), dtype=np.uint8)
    tables = neighbours.Tables(own)
    for radius in (0, 1, 3, 4, 7, 11, 32):
        code = rng.integers(0, 256, 4, dtype=np.uint8)
        away = np.bitwise_count(own ^ code).sum(axis=1)
        assert tables.within(code, radius).tolist() == np.flatnonzero(away <= radius).tolist()


def test_search_odd_rows(spark, odd_vectors):
    got = by_query(neighbours.search(odd_vectors, odd_vectors, k=3))
    assert sorted(got) == [8, 9, 10, 11, 12]  # the id that occurs twice asks twice; nothing has as many components as 7
    assert [r["vec_id"] for r in got[8]] == [10, 9, 9]
    assert [r["vec_id"] for r in got[11]] == [10, 8, 9]
    few = by_query(neighbours.search(odd_vectors.where("vec_id in (8, 11)"), odd_vectors, k=20))
    assert [r["vec_id"] for r in few[8]] == [11] and [r["vec_id"] for r in few[10]] == [8, 11]


def test_search_of_mixed_numbers_of_components(spark):
    """Each number of components is searched for itself, also those for which no rotation is learned."""
    rng = np.random.default_rng(7)
    sizes = [3, 8, 8, 8, 40]
    vectors = [rng.standard_normal(sizes[i % 5]).astype(np.float32).tolist() for i in range(1500)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    asked = [q for q in range(0, 1500, 50)] + [4, 54]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(neighbours, "LEARNED", 2)
        got = by_query(neighbours.search(rows, rows.where(F.col("vec_id").isin(asked)), k=10, radius=128, block_rows=400, block_queries=9))
    assert sorted(got) == sorted(asked)
    for q, found in got.items():
        own = np.array([i for i in range(1500) if len(vectors[i]) == len(vectors[q])])
        x = np.array([vectors[i] for i in own])
        assert [(r["vec_id"], r["score"]) for r in found] == exact(x, own, (q, np.array(vectors[q])), 10)


def test_recall_with_spread_lengths(spark):
    """Lengths that differ continuously leave many ranges; all go through their codes."""
    rng = np.random.default_rng(8)
    x = (rng.standard_normal((4000, 32)) * np.exp(rng.standard_normal((4000, 1)))).astype(np.float32)
    rows = table(spark, x)
    got = by_query(neighbours.search(rows, rows.where("vec_id % 100 = 0"), k=20))
    hits = sum(len({r["vec_id"] for r in found} & {i for i, _ in exact(x, np.arange(4000), (q, x[q]), 20)}) for q, found in got.items())
    assert len(got) == 40 and hits >= 0.9 * 20 * 40


def test_search_empty(odd_vectors):
    none = odd_vectors.limit(0)
    for rows, queries in ((none, odd_vectors), (odd_vectors, none), (none, none)):
        out = neighbours.search(rows, queries)
        assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 0


def test_search_query(spark):
    t = pq.read_table(f"{SMALL}/embeddings.parquet").sort_by("vec_id").combine_chunks()
    x, ids = t["embedding"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1), t["vec_id"].to_numpy()
    got = by_query(QUERIES["op2_multi_index_hashing"](spark, SMALL))
    hits = 0
    for q in ids[ids % 20 == 0].tolist():
        best = exact(x, ids, (q, x[np.searchsorted(ids, q)]), 20)
        found = got.pop(q)
        hits += len({i for i, _ in best} & {r["vec_id"] for r in found})
        assert [r["rank"] for r in found] == list(range(1, 21))
    assert not got and hits >= 0.9 * 20 * (ids % 20 == 0).sum()


def components_of(ids, x, threshold):
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    linked = np.argwhere(np.triu(unit @ unit.T >= threshold, 1))
    union, n = Union(), dict.fromkeys(map(int, ids), 0)
    for i in n:
        union.find(i)
    for a, b in linked.tolist():
        union.join(int(ids[a]), int(ids[b]))
        n[int(ids[a])] += 1
        n[int(ids[b])] += 1
    return {(i, n[i], union.find(i), union.find(i) == i) for i in n}


def test_near_duplicates(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((30, 24))[rng.integers(0, 30, 900)] + 0.45 * rng.standard_normal((900, 24))
    x = np.concatenate([x, np.repeat(x[:1], 200, axis=0)]).astype(np.float32)
    ids = rng.permutation(5000)[: len(x)]
    got = similar_vectors.near_duplicates(table(spark, x, ids), 0.8, block_rows=150)
    expected = components_of(ids, x, 0.8)
    assert {tuple(r) for r in got.collect()} == expected
    assert 1 < len({c for _, _, c, _ in expected}) < 900 and sum(n for _, n, _, _ in expected) > 10_000


def test_near_duplicates_odd_rows(spark, odd_vectors):
    rows = {tuple(r) for r in similar_vectors.near_duplicates(odd_vectors, 0.9).collect()}
    alone = {(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 11)}
    assert rows == alone | {(None, 0, None, False), (8, 3, 8, True), (9, 3, 8, False), (10, 3, 8, False), (12, 3, 8, False)}
    assert similar_vectors.near_duplicates(odd_vectors.limit(0)).count() == 0
    assert {tuple(r) for r in similar_vectors.near_duplicates(odd_vectors.where("vec_id < 4")).collect()} == {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)}


def test_near_duplicates_of_repeated_ids_and_mixed_lengths(spark, tmp_path):
    """All vectors of an id count, each number of components by itself; the query's SQL says the same."""
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 1.0]), (4, [1.0, 0.0, 0.0]), (5, [2.0, 0.0, 0.0]), (5, [1.0, 0.0]), (5, [1.0, 0.0]), (6, [3.0]), (7, [4.0]), (8, [-1.0]), (9, [])]
    rng = np.random.default_rng(8)
    for i in range(30, 220):
        dims = int(rng.choice([4, 5, 9]))
        rows.append((int(i // rng.choice([1, 2, 3])), (np.eye(dims)[rng.integers(0, dims)] + 0.25 * rng.standard_normal(dims)).tolist()))
    pq.write_table(pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float64()))}), tmp_path / "embeddings.parquet")
    own = {}
    for i, v in rows:
        own.setdefault(i, []).append(np.array(v))

    def near(a, b):
        return len(a) == len(b) > 0 and a @ b >= 0.9 * np.linalg.norm(a) * np.linalg.norm(b)

    union, links = Union(), {i: {j for j in own if j != i and any(near(a, b) for a in own[i] for b in own[j])} for i in own}
    for i, others in links.items():
        union.find(i)
        for j in others:
            union.join(i, j)
    expected = {(i, len(links[i]), union.find(i), union.find(i) == i) for i in own}
    assert (1, 2, 1, True) in expected and (3, 1, 1, False) in expected and (7, 1, 6, False) in expected
    got = similar_vectors.near_duplicates(spark.read.parquet(f"{tmp_path}/embeddings.parquet"), 0.9, block_rows=20)
    assert {tuple(r) for r in got.collect()} == expected and got.count() == len(own)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet')")
    assert set(con.execute(ORACLE["op8_rotated_codes"]).fetchall()) == expected


def test_near_duplicates_query(spark):
    # lower the threshold so that the small table has links
    t = pq.read_table(f"{SMALL}/embeddings.parquet")
    x, ids = np.array(t["embedding"].to_pylist(), dtype=np.float32), t["vec_id"].to_numpy()
    assert {tuple(r) for r in QUERIES["op8_rotated_codes"](spark, SMALL).collect()} == components_of(ids, x, 0.9)
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    assert {tuple(r) for r in similar_vectors.near_duplicates(rows, 0.4, block_rows=100).collect()} == components_of(ids, x, 0.4)


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    a, b = rng.standard_normal(64), rng.standard_normal(64)
    b = 0.8 * a / np.linalg.norm(a) + 0.6 * (b - (b @ a) * a / (a @ a)) / np.linalg.norm(b - (b @ a) * a / (a @ a))
    a = a / np.linalg.norm(a)
    got = []
    for seed in range(600):
        turn = similar_vectors.rotation(64, seed)
        signs, factors = similar_vectors.encode(a[None], turn)
        guess = float(similar_vectors.estimates(signs, factors, b[None] @ turn)[0, 0])
        assert abs(guess - 0.8) <= similar_vectors.bounds(factors, 64)[0]
        got.append(guess)
    assert abs(np.mean(got) - 0.8) < 4 * np.std(got) / np.sqrt(len(got))


def test_usable(odd_vectors):
    assert sorted(r["vec_id"] for r in odd_vectors.where(neighbours.usable("embedding") & F.col("vec_id").isNotNull()).collect()) == [7, 8, 9, 9, 10, 11, 12]


@pytest.mark.parametrize("every, times", [(2000, 2.0), (100, 2.0), (2000, 50.0)])
def test_recall_with_long_vectors(spark, every, times):
    """A few long vectors don't cost the others their neighbours."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").toPandas()
    x = np.stack(table["embedding"].to_numpy()).astype(float)
    x[::every] *= times
    ids = table["vec_id"].to_numpy()
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(rows, rows.where("vec_id % 20 = 0"), k=20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = []
    for at in np.flatnonzero(ids % 20 == 0):
        score = x @ x[at]
        score[at] = -np.inf
        hits.append(len(set(ids[np.argsort(-score)[:20]].tolist()) & got[int(ids[at])]) / 20)
    print("recall", every, times, np.mean(hits))
    assert np.mean(hits) >= 0.9
