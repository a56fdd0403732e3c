"""Clusters against a plain version in Python integers; bounds against the distances that they bound."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from stratalake.llm.centroids import Simplex, cluster, pivots, squared

SCHEMA = "vec_id long, embedding array<double>, cluster string"


def plain(rows, dims, k=4, rounds=3, scale=64):
    kept = []
    for i, v, _ in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v) and all(abs(x * scale) < 2**27 for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [q for _, q in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(centres)) for _, q in kept]

    for _ in range(rounds):
        told = assign()
        for j in range(len(centres)):
            own = [q for (_, q), (_, c) in zip(kept, told, strict=True) if c == j]
            if own:
                centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    told = assign()
    inertia = [sum(d for d, c in told if c == j) for j in range(len(centres))]
    shown = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((str(i), c, d, inertia[c], sum(inertia), shown[c]) for (i, _), (d, c) in zip(kept, told, strict=True))


def found(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def points(seed, n, dims):
    pick = random.Random(seed)
    middles = [[pick.gauss(0, 1) for _ in range(dims)] for _ in range(3)]
    return [(i, [x + pick.gauss(0, 0.3) for x in pick.choice(middles)], "x") for i in range(n)]


@pytest.mark.parametrize("dims, n", [(8, 300), (3, 40), (8, 2), (64, 60)])
def test_against_plain(spark, dims, n):
    rows = points(n, n, dims)
    assert found(cluster(spark.createDataFrame(rows, SCHEMA), k=4, dims=dims)) == plain(rows, dims)


def test_odd_rows(spark):
    """Unfit vectors are left out, repeated ids and rows stay, ties go to the smaller number, null ids come last."""
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 0.0], "a"), (1, [0.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (2, None, "a"), (3, [], "a"), (4, [1.0], "a"), (5, [1.0, None], "a"),
        (6, [nan, 1.0], "a"), (7, [inf, 1.0], "a"), (None, [0.5, 0.5], "a"), (None, [-0.01, 0.01], None), (8, [-1.0, 0.0], "a"), (9, [1.0, 2.0, 3.0], "a"),
    ]
    assert found(cluster(spark.createDataFrame(rows, SCHEMA), k=3, dims=2)) == plain(rows, 2, 3)
    same = [(i, [0.25, -0.25], "a") for i in range(9)]
    told = found(cluster(spark.createDataFrame(same, SCHEMA), k=3, dims=2))
    assert told == plain(same, 2, 3) and {r[1] for r in told} == {0}
    far = spark.createDataFrame([*rows, (77, [1e30, 0.0], "a")], SCHEMA)
    out = {str(r["vec_id"]): r for r in cluster(far, k=3, dims=2).collect()}
    assert out["77"]["cluster"] is None and out["77"]["distance"] is None and len(out) > 3
    assert cluster(far.limit(0), k=3, dims=2).count() == 0


def test_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(points(9, 200, 8), SCHEMA)
    assert found(cluster(df.repartition(7), dims=8)) == found(cluster(df.coalesce(1), dims=8))


@pytest.mark.parametrize("dims", [2, 8, 64])
def test_bounds_hold_and_rule_out(dims):
    rng = np.random.default_rng(dims)
    x = rng.integers(-90, 90, (500, dims))
    c = x[:6].copy()
    simplex = Simplex(pivots(c, x[:300]))
    tops = simplex.apexes(squared(x, simplex.pivots))
    # the distances to the pivots themselves are kept
    assert np.allclose(squared(x, simplex.pivots[:1])[:, 0], (tops**2).sum(axis=1))
    away = squared(x, c)
    able = Simplex.candidates(tops, simplex.apexes(squared(c, simplex.pivots)))
    assert able[np.arange(len(x)), away.argmin(axis=1)].all()
    # the pivots' plane holds the initial centroids: little but the nearest is left
    assert able.mean() < 1.2 / 6
    moved = c + rng.integers(-20, 20, c.shape)
    able = Simplex.candidates(tops, simplex.apexes(squared(moved, simplex.pivots)))
    assert able[np.arange(len(x)), squared(x, moved).argmin(axis=1)].all()
