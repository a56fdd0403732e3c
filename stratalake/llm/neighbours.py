"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes.

Codes. On a bounded sample, rotations are learned that lose least when each coordinate is replaced by
its sign (iterative quantisation); ``bits`` signs, from as many rotations as that takes, make
the code. For the largest inner product, a vector first gets one more coordinate that gives all
vectors of a range of similar lengths the same length, so that nearness of direction is nearness by inner product.
Each range is searched for itself, so a few long vectors don't shorten the others. Vectors with different numbers of
components have no inner product: each number is searched for itself, the most common ones with learned rotations, rare ones with random ones.

Search. Codes are split into eight-bit substrings, each with a table from value to (a bitmap of) rows. Within radius
``r`` of a query, by the pigeonhole principle, at least one substring differs in few bits:
with ``m`` substrings and ``r = m * t + a``, in at most ``t`` bits for one of the first ``a + 1``, or
``t - 1`` for one of the others. Probing those values (their bitmaps are joined once for each table, since
there are few values) finds every code within the radius; their
vectors are compared in double precision. A query that finds fewer than ``k`` is asked
again with a larger radius, up to all bits, so no query gets fewer than there are. (Fewer than
``ENOUGH * k`` codes count as too few: among so few the nearest may lie just outside.)

Scale. Rows and queries are dealt into blocks; every pair of blocks is one group with tables of its own,
which keeps memory bounded, and each query keeps ``k`` rows of a group. The work is that
of a given set of queries against all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bits of a code, radius of the first search, by how much it grows, how many codes per wanted row are enough; rows that the rotations are learned from, for how many numbers of
#: components; ranges of lengths between a length and its double, size of the blocks.
BITS = 128
RADIUS = 56
STEP = 4
ENOUGH = 10
SAMPLE = 4096
LEARNED = 16
RANGES = 4
ROUNDS = 20
BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not empty, not all zero."""

    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    c = F.col(vector)
    return c.isNotNull() & (F.size(c) > 0) & ~F.exists(c, bad) & F.exists(c, lambda x: x != 0)


def rotations(sample: np.ndarray, bits: int, rounds: int = ROUNDS, seed: int = 1) -> np.ndarray:
    """Columns whose signs are the bits: per block of as many bits as there are dimensions, one learned rotation."""
    dims = sample.shape[1]
    rng = np.random.Generator(np.random.PCG64(seed))
    made = []
    for _ in range(-(-bits // dims)):
        turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        for _ in range(rounds if len(sample) else 0):
            u, _, v = np.linalg.svd(np.where(sample @ turn >= 0, 1.0, -1.0).T @ sample, full_matrices=False)
            turn = (u @ v).T
        made.append(turn)
    return np.concatenate(made, axis=1)[:, :bits]


def ranges(length: np.ndarray) -> list[np.ndarray]:
    """Places of the vectors of each range of lengths (a range's longest is at most ``2 ** (1 / RANGES)`` times its shortest)."""
    step = np.rint(np.log2(length) * RANGES)
    order = np.argsort(step, kind="stable")
    return [np.sort(x) for x in np.split(order, np.flatnonzero(np.diff(step[order])) + 1)]


def lifted(x: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Vectors of one range with one more coordinate, all of length 1."""
    share = length / length.max()
    return np.concatenate([x / length.max(), np.sqrt(np.maximum(1 - share * share, 0.0))[:, None]], axis=1)


def lengths(x: np.ndarray) -> np.ndarray:
    """Lengths of vectors that are not all zero; neither very large nor very small components are lost."""
    top = np.abs(x).max(axis=1)
    return top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1))


def learned(sample: list[np.ndarray], bits: int) -> dict[int, np.ndarray]:
    """Rotations of the numbers of components that are most common in a sample."""
    by_size: dict[int, list[np.ndarray]] = {}
    for v in sample:
        by_size.setdefault(len(v), []).append(v)
    common = sorted(by_size, key=lambda d: (-len(by_size[d]), d))[:LEARNED]
    turns = {}
    for dims in common:
        x = np.array(by_size[dims])
        length = lengths(x)
        turns[dims] = rotations(np.concatenate([lifted(x[own], length[own]) for own in ranges(length)]), bits)
    return turns


def codes(vectors: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """One row of bytes per vector."""
    return np.packbits(vectors @ turn >= 0, axis=1)


class Tables:
    """For each substring and value, the rows that have it, as a bitmap; and those within some flips of it."""

    def __init__(self, own: np.ndarray):
        self.codes = own
        words = np.pad(own, ((0, 0), (0, -own.shape[1] % 8)))
        self.words = np.ascontiguousarray(words.view(np.uint64).T)  # one row per 64 bits of all codes
        self._within: dict[int, np.ndarray] = {}
        values = np.arange(256)
        self._within[0] = np.stack([np.packbits(own[:, j] == values[:, None], axis=1) for j in range(own.shape[1])])

    def _near(self, flips: int) -> np.ndarray:
        """Bitmaps by substring and value of the rows whose substring differs from it in at most so many bits."""
        if flips not in self._within:
            before = self._near(flips - 1)
            after = before.copy()
            for bit in range(8):
                after |= before[:, np.arange(256) ^ (1 << bit)]
            self._within[flips] = after
        return self._within[flips]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within the radius of a code."""
        m = self.codes.shape[1]
        t, a = divmod(min(radius, 8 * m), m)
        met = np.bitwise_or.reduce(self._near(min(t, 8))[np.arange(a + 1), code[: a + 1]], axis=0)
        if t > 0 and a + 1 < m:
            met |= np.bitwise_or.reduce(self._near(t - 1)[np.arange(a + 1, m), code[a + 1 :]], axis=0)
        own = np.pad(code, (0, -m % 8)).view(np.uint64)
        away = np.zeros(len(self.codes), dtype=np.uint16)
        for word, bits in zip(self.words, own, strict=True):
            away += np.bitwise_count(word ^ bits)
        return np.flatnonzero((away <= radius) & np.unpackbits(met, count=len(self.codes)).view(bool))


def search(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector: str = "embedding",
    bits: int = BITS,
    radius: int = RADIUS,
    sample: int = SAMPLE,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """Per query its ``k`` nearest rows found, by inner product: ``query_id``, ``rank`` (from 1), the row's id, ``score``.

    A row with the query's id is no candidate, nor is one with another number of components. Vectors that are not ``usable``
    take no part, neither as row nor as query. Ties go to the
    smaller id. Rows repeated under one id are found as often as they occur. Null ids take no part. Other columns, whatever
    their names, are not read.
    """

    def narrow(df: DataFrame) -> DataFrame:
        return df.where(usable(vector) & F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))

    rows, queries = narrow(rows), narrow(queries)
    told = rows.agg(F.count("*").alias("n")).first()
    asked = queries.count()
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).collect()  # a bounded sample, for the rotations only
    result = "query_id long, rank int, " + f"`{id_column}` long, score double"
    if not told["n"] or not asked:
        return rows.sparkSession.createDataFrame([], result)
    turns = learned([np.array(r["v"]) for r in drawn], bits)
    row_blocks, query_blocks = -(-told["n"] // block_rows), -(-asked // block_queries)
    left = rows.withColumn("d", F.size("v")).withColumn("rb", F.pmod(F.xxhash64("id"), F.lit(row_blocks))).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = queries.withColumn("d", F.size("v")).withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int"))
    right = right.withColumn("rb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))))

    def matrix(table: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray]:
        v = table.column("v").combine_chunks()
        v = v.flatten() if isinstance(v, pa.ListArray) else v.chunk(0).flatten()
        return table.column("id").to_numpy(), np.asarray(v, dtype=np.float64).reshape(-1, dims)

    def group(key: tuple[pa.Scalar, ...], own: pa.Table, asks: pa.Table) -> pa.Table:
        if own.num_rows == 0 or asks.num_rows == 0:
            return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        dims = key[0].as_py()
        turn = turns[dims] if dims in turns else rotations(np.empty((0, dims + 1)), bits)
        ids, x = matrix(own, dims)
        names, q = matrix(asks, dims)
        zero = np.zeros((len(q), 1))
        length = lengths(x)
        parts = [(own, Tables(codes(lifted(x[own], length[own]), turn))) for own in ranges(length)]
        q_codes = codes(np.concatenate([q, zero], axis=1), turn)

        def met_in(places: np.ndarray, tables: Tables, i: int) -> np.ndarray:
            reach = radius
            others = np.count_nonzero(ids[places] != names[i])
            while True:
                found = places[tables.within(q_codes[i], reach)]
                found = found[ids[found] != names[i]]
                if len(found) >= min(ENOUGH * k, others) or reach >= bits:
                    return found
                reach = min(bits, reach + STEP) if len(found) else bits

        out_q, out_i, out_s = [], [], []
        for i in range(len(q)):
            found = np.sort(np.concatenate([met_in(places, tables, i) for places, tables in parts]))
            score = x[found] @ q[i]
            if len(found) > k:
                edge = np.partition(score, len(score) - k)[len(score) - k]
                near = score >= edge - 1e-9 * (1 + abs(edge))
                found, score = found[near], score[near]
            own_ids = ids[found]
            # a fixed order of additions: the score of a pair is the same in every group and size
            score = _products(x[found], q[i])
            best = np.lexsort((own_ids, -score))[:k]
            out_q.append(np.full(len(best), names[i]))
            out_i.append(own_ids[best])
            out_s.append(score[best])
        return pa.table({"query_id": np.concatenate(out_q), "id": np.concatenate(out_i), "score": np.concatenate(out_s)})

    met = left.groupBy("d", "rb", "qb").cogroup(right.groupBy("d", "rb", "qb")).applyInArrow(group, "query_id long, id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    total = np.zeros(len(x))
    for d in range(len(q)):
        total += x[:, d] * q[d]
    return total
