"""Near-duplicate vectors by randomised-rotation binary codes with correction factors.

A unit vector ``o`` is turned by a random rotation and replaced by the signs of its coordinates,
``x = sign(P o) / sqrt(D)``. Beside the signs the factor ``f = <x, P o>`` is stored. For another unit vector
``q``, ``<x, P q> / f`` is an unbiased estimate of ``<o, q>``, whose error stays below
``epsilon * sqrt((1 - f * f) / (f * f * (D - 1)))`` but for a share of pairs that falls exponentially
with the square of ``epsilon``. A pair whose estimate and bound stay below the threshold is no link;
every other pair is recomputed from the original vectors in double precision.

Rows are dealt into blocks of about ``block_rows``, and every pair of blocks is one group, so that memory is
bounded and all pairs are judged, each once. A group returns one row per linked vector,
with its number of links and the smallest id that it reaches within the group, never the pairs.
Vectors in general position in many dimensions leave no exact bound by which blocks could be
skipped; the work is quadratic, with a small constant (one float product per component and pair).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import Scratch

from .components import components
from .neighbours import usable
from .store import stored

BLOCK_ROWS = 4096
EPSILON = 5.0
_STRIP = 512


def rotation(dims: int, seed: int = 3) -> np.ndarray:
    turn, r = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((dims, dims)))
    return turn * np.sign(np.diag(r))


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the turned unit vectors, and their correction factors."""
    turned = unit @ turn
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])


def estimates(signs: np.ndarray, factors: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """Estimated inner products of coded vectors (rows) with turned unit vectors (columns)."""
    dims = turned.shape[1]
    x = np.unpackbits(signs, axis=1, count=dims).astype(np.float32) * np.float32(2) - np.float32(1)
    return (x / (np.sqrt(dims) * factors)[:, None].astype(np.float32)) @ turned.T.astype(np.float32)


def bounds(factors: np.ndarray, dims: int, epsilon: float = EPSILON) -> np.ndarray:
    return epsilon * np.sqrt(np.maximum(1 - factors**2, 0) / (factors**2 * max(dims - 1, 1))) + 1e-5


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, added up in a fixed order."""
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for d in range(a.shape[1]):
        dot += a[:, d] * b[:, d]
        aa += a[:, d] * a[:, d]
        bb += b[:, d] * b[:, d]
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def smallest_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0 to n - 1 and edges (a, b), the smallest node of each one's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], low)
        np.minimum.at(after, root[b], low)
        while True:
            hop = after[after]
            if (hop == after).all():
                break
            after = hop
        if (after == root).all():
            return root
        root = after


def links_within(ids: np.ndarray, x: np.ndarray, first: np.ndarray, second: np.ndarray | None, turn: np.ndarray, threshold: float, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (places in ``x``) between the rows ``first`` and ``second``, or within ``first`` if that is None."""
    unit = x / np.sqrt((x * x).sum(axis=1))[:, None]
    signs, factors = encode(unit, turn)
    margin = threshold - bounds(factors, x.shape[1], epsilon)
    others = first if second is None else second
    turned = unit[others] @ turn
    got_a, got_b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for lo in range(0, len(first), _STRIP):
        rows = first[lo : lo + _STRIP]
        from_ = lo + 1 if second is None else 0  # within one block: the places after the row's own
        guess = estimates(signs[rows], factors[rows], turned[from_:])
        i, j = np.nonzero(guess >= margin[rows][:, None].astype(np.float32))
        j = j + from_
        if second is None:
            later = j > i + lo
            i, j = i[later], j[later]
        a, b = rows[i], others[j]
        for at in range(0, len(a), 1 << 16):
            p, q = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            linked = cosines(x[p], x[q]) >= threshold
            got_a.append(p[linked])
            got_b.append(q[linked])
    return np.concatenate(got_a), np.concatenate(got_b)


def near_duplicates(rows: DataFrame, threshold: float = 0.9, id_column: str = "vec_id", vector: str = "embedding", block_rows: int = BLOCK_ROWS, epsilon: float = EPSILON) -> DataFrame:
    """One row per id: the id, ``n_links``, ``component_id`` and ``kept``.

    Two vectors are linked if their cosine is at least ``threshold``; a component is named by its smallest
    id, which is the one kept. Vectors are compared with those of the same number of components; those that are not ``usable`` are
    linked with nothing. All vectors of one id stand under it: ``n_links`` counts the other ids that any of them is linked with, each once.
    A null id is one row without component, not kept. An empty table gives an empty result. Other columns are not read.
    """
    with Scratch(rows.sparkSession, "vectors") as scratch:
        return stored(_near_duplicates(rows, threshold, id_column, vector, block_rows, epsilon, scratch), "vectors")


def _near_duplicates(rows: DataFrame, threshold: float, id_column: str, vector: str, block_rows: int, epsilon: float, scratch: Scratch) -> DataFrame:
    all_ids = rows.select(F.col(id_column).cast("long").alias("id")).distinct()
    own = rows.where(usable(vector) & F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    own = scratch.save(own.distinct())
    # ids with several vectors; ``n`` distinct numbers of components need n * (n + 1) / 2 components, so they are few
    several = own.groupBy("id").agg(F.count("*").alias("k")).where("k > 1").select("id", F.lit(True).alias("several"))
    blocks = own.groupBy(F.size("v").alias("dims")).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    dealt = own.join(several, "id", "left").withColumn("several", F.coalesce("several", F.lit(False))).withColumn("dims", F.size("v")).join(F.broadcast(blocks), "dims")
    # by id and vector, so that the vectors of one id are spread, too
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).select("id", "v", "several", "dims", "block", F.least("block", "other").alias("gi"), F.greatest("block", "other").alias("gj"))

    def group(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dims, gi, gj = (k.as_py() for k in key)
        ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
        v = table.column("v")
        flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in v.chunks])
        x, many = flat.reshape(-1, dims), table.column("several").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, block, x, many = ids[order], block[order], x[order], many[order].astype(bool)
        second = None if gi == gj else np.flatnonzero(block == gj)
        a, b = links_within(ids, x, np.flatnonzero(block == gi), second, rotation(dims), threshold, epsilon)
        root = ids[smallest_reached(len(ids), a, b)]
        # pairs of an id with several vectors may be met again elsewhere: they are named, all others counted
        named = many[a] | many[b]
        n = np.bincount(a[~named], minlength=len(ids)) + np.bincount(b[~named], minlength=len(ids))
        pairs = np.stack([np.r_[ids[a[named]], ids[b[named]]], np.r_[ids[b[named]], ids[a[named]]]], axis=1)
        pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
        some = np.zeros(len(ids), dtype=bool)
        some[a] = some[b] = True
        none = np.zeros(len(pairs), dtype=np.int64)
        return pa.table({
            "id": np.r_[ids[some], pairs[:, 0]], "n": np.r_[n[some].astype(np.int64), none], "root": np.r_[root[some], pairs[:, 0]],
            "other": pa.array(np.r_[np.zeros(some.sum(), dtype=np.int64), pairs[:, 1]], mask=np.r_[np.ones(some.sum(), dtype=bool), none.astype(bool)]),
        })

    found = scratch.save(dealt.groupBy("dims", "gi", "gj").applyInArrow(group, "id long, n long, root long, other long"))
    classes = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), scratch)
    counts = found.groupBy(F.col("id").alias("node")).agg((F.sum("n") + F.count_distinct("other")).alias("n"))
    linked = counts.join(classes, "node").select(F.col("node").alias("id"), "n", "component")
    out = all_ids.join(linked, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_column),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
