"""Centroid clustering of integer vectors; most centroids are ruled out by n-simplex projections.

Vectors become integers (``floor(scale * x)``) once, and their exact squared distances to a few pivots are kept
beside them. Pivots are the initial centroids, the mean of a sample and points on its principal axes. From such distances alone a point gets coordinates: the apex of the simplex that it forms
over the pivots. Two apexes bound the distance of the points themselves, from below by their Euclidean distance and from
above by that to the apex mirrored at the pivots' plane. In each round a vector is compared exactly, in
64-bit integers, only with centroids whose lower bound does not exceed the least upper bound; ties go to the smaller number.

A round is one pass over the stored vectors without a shuffle of rows: every task sends one row of counts and sums per
cluster, and ``k`` centroids go to the driver and back.

Vectors that are null, of another number of components, or hold null or non-finite components are left out. Components of ``2 ** 27`` and
more after scaling have distances beyond a long: such vectors are returned with nulls instead of a cluster and have no part in it.
Repeated ids and rows are vectors of their own; initial centroids go by hash, then by components; null ids come after all
others. Fewer than ``k`` vectors give fewer centroids, an empty table an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import Scratch

from .store import column, ragged, stored

#: Parameters: the vectors whose mean and principal axes give pivots, and how many pivots there are at most.
SAMPLE = 2048
PIVOTS = 48
_LARGEST = 2.0**27
#: Bounds are widened by this share of the squared lengths, far more than double precision loses.
_SLACK = 1e-6


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to those of ``y``."""
    out = np.empty((len(x), len(y)), dtype=np.int64)
    for j, row in enumerate(y):
        away = x - row
        out[:, j] = np.einsum("ij,ij->i", away, away)
    return out


class Simplex:
    """Pivots in general position, and the apexes of other points over them."""

    def __init__(self, points: np.ndarray, most: int = PIVOTS):
        """The first ``most`` of ``points`` that lie clearly outside the plane of those before them."""
        inside = (points - points[0]).astype(np.float64)
        left, chosen, axes = inside.copy(), [0], []
        least = 1e-4 * float(np.einsum("ij,ij->i", inside, inside).max())
        for i in range(1, len(points)):
            height = float(left[i] @ left[i])
            if height > least and len(chosen) < most:
                axes.append(left[i] / np.sqrt(height))
                chosen.append(i)
                left -= np.outer(left @ axes[-1], axes[-1])
        self.pivots = points[chosen]
        edges = inside[chosen[1:]]
        self.lengths = np.einsum("ij,ij->i", edges, edges)
        self.base = edges @ np.array(axes).T if axes else np.zeros((0, 0))

    def apexes(self, distances: np.ndarray) -> np.ndarray:
        """Coordinates from squared distances to the pivots: places in the plane of the pivots, then the height above it."""
        far = distances.astype(np.float64)
        along = (far[:, :1] + self.lengths - far[:, 1:]) / 2
        flat = np.linalg.solve(self.base, along.T).T if len(self.base) else along
        height = np.sqrt(np.maximum(far[:, 0] - np.einsum("ij,ij->i", flat, flat), 0.0))
        return np.column_stack([flat, height])

    @staticmethod
    def candidates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which points ``y`` can be nearest to each ``x``, by the bounds of their apexes."""
        long_x, long_y = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
        lower = long_x[:, None] + long_y - 2 * (x @ y.T)
        upper = lower + 4 * np.outer(x[:, -1], y[:, -1])
        slack = _SLACK * (long_x[:, None] + long_y)
        return lower - slack <= (upper + slack).min(axis=1)[:, None]


def pivots(first: np.ndarray, sample: np.ndarray) -> np.ndarray:
    """Points that centroids lie near the plane of: the sample's mean, the initial centroids, and points on the sample's principal axes."""
    middle = sample.mean(axis=0)
    _, size, axes = np.linalg.svd(sample - middle, full_matrices=False)
    along = middle + axes * (size.max() + 1) / np.sqrt(len(sample)) * np.sqrt(sample.shape[1])
    return np.concatenate([np.rint(middle)[None].astype(np.int64), first, np.rint(along).astype(np.int64)])


def nearest(points: np.ndarray, apexes: np.ndarray, centres: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the exact squared distance; of equal ones the smaller number."""
    able = Simplex.candidates(apexes, tops)
    best = np.full(len(points), np.iinfo(np.int64).max, dtype=np.int64)
    which = np.zeros(len(points), dtype=np.int32)
    for j, centre in enumerate(centres):
        rows = np.flatnonzero(able[:, j])
        away = points[rows] - centre
        away = np.einsum("ij,ij->i", away, away)
        nearer = away < best[rows]
        best[rows[nearer]] = away[nearer]
        which[rows[nearer]] = j
    return which, best


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1", id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """One row per vector: its id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Centroids start as the ``k`` vectors with the smallest sha256 of ``seed:id``.
    """
    spark = vectors.sparkSession
    sound = F.expr(f"size(v) = {dims} and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v")).where(sound)
    small = F.expr(f"forall(v, x -> abs(floor(x * {scale}D)) < {_LARGEST})")
    whole = rows.where(small).select("id", F.expr(f"transform(v, x -> cast(floor(x * {scale}D) as int))").alias("q"))
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = whole.orderBy(draw.asc_nulls_last(), "q").limit(k).collect()
    centres = np.array([r["q"] for r in first], dtype=np.int64).reshape(-1, dims)
    sample = whole.orderBy(F.xxhash64(F.lit("pivot"), "id"), "q").limit(SAMPLE).collect()
    simplex = Simplex(pivots(centres, np.array([r["q"] for r in sample] or [[0] * dims], dtype=np.int64)))
    n_pivots = len(simplex.pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = squared(_matrix(column(batch, "q"), dims), simplex.pivots)
            lists = ragged(far.ravel(), np.full(len(far), n_pivots), pa.int64())
            yield pa.RecordBatch.from_arrays([column(batch, "id"), column(batch, "q"), lists], names=["id", "q", "far"])

    def dealt(batches: Iterator[pa.RecordBatch], centres: np.ndarray):
        tops = simplex.apexes(squared(centres, simplex.pivots))
        for batch in batches:
            if batch.num_rows:
                points = _matrix(column(batch, "q"), dims)
                yield batch, points, *nearest(points, simplex.apexes(_matrix(column(batch, "far"), n_pivots)), centres, tops)

    def totals(centres: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums = np.zeros(len(centres), dtype=np.int64), np.zeros(centres.shape, dtype=np.int64)
            for _, points, which, _ in dealt(batches, centres):
                n += np.bincount(which, minlength=len(centres))
                for j in np.unique(which).tolist():
                    sums[j] += points[which == j].sum(axis=0)
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(met.astype(np.int32)), pa.array(n[met]), ragged(sums[met].ravel(), np.full(len(met), dims), pa.int64())], names=["cluster", "n", "sums"]
            )

        return run

    id_type = vectors.schema[id_column].dataType
    with Scratch(spark, "centroids") as scratch:
        fields = [T.StructField("id", id_type), T.StructField("q", T.ArrayType(T.IntegerType())), T.StructField("far", T.ArrayType(T.LongType()))]
        cached = scratch.save(whole.mapInArrow(measure, T.StructType(fields)))
        for _ in range(rounds if len(centres) else 0):
            parts = cached.mapInArrow(totals(centres), "cluster int, n long, sums array<long>")
            parts = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
            # at most k * dims rows, whatever the input
            for r in parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():
                centres[r["cluster"], r["at"]] = int(r["total"]) // r["n"]

        def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, _, which, best in dealt(batches, centres):
                yield pa.RecordBatch.from_arrays([column(batch, "id"), pa.array(which), pa.array(best)], names=["id", "cluster", "distance"])

        fields = [T.StructField("id", id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
        found = cached.mapInArrow(settle, T.StructType(fields))
        beyond = rows.where(~small).select("id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance"))
        found = stored(found.unionByName(beyond), "clusters")
    # at most k rows
    sums = {r["cluster"]: int(r["s"]) for r in found.where("cluster is not null").groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    told = [(j, fits(s), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, centres[j].tolist())).encode()).hexdigest()) for j, s in sums.items()]
    told = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(told), "cluster", "left")
    return out.select(F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
