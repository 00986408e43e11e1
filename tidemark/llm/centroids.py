"""Exact integer k-means whose nearest centroids are found through an n-simplex projection.

Distances of a vector to n pivots fix its apex over the simplex of the pivots: n - 1 coordinates in their plane and the
height above it. For two apexes the Euclidean distance is a lower bound of the true one and, with one height turned over,
an upper bound. A vector's apex is computed once and stored beside it; centroids get theirs in every round. Centroids whose lower
bound exceeds the least upper bound cannot be nearest; among the rest exact integer distances decide.
The pivots are the first centroids, so that bounds are tight where centroids begin.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from ..session import materialise

DIMENSIONS, SCALE = 64, 1024
CLUSTERS, ROUNDS, SEED = 8, 10, 3
#: Largest magnitude of an integer component: squared distances then fit a BIGINT.
MOST = 1 << 27
#: A pivot joins the simplex if its height above those before it is at least this share of its distance to the first.
LEAST_HEIGHT = 0.05
#: Slack of the bounds, a share of the largest distances involved; far above rounding with heights as above.
SLACK = 1e-6


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """Rows (vec_id, v array<bigint>): floor(scale * x) of the vectors with exactly ``dimensions`` components, none null or non-finite.

    A component beyond MOST after scaling is an error, as distances would not fit.
    """
    x = F.col("x")
    finite = (F.size(x) == dimensions) & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    whole = F.transform(x, lambda c: F.when(F.abs(c) * scale <= MOST, F.floor(c * scale)).otherwise(F.raise_error(F.lit(f"a component is beyond {MOST} / {scale}"))).cast("bigint"))
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("x"))
    return rows.filter(finite).select("vec_id", whole.alias("v"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The k vectors of the smallest hashes of their ids, in that order; rows of one id by their components, null ids last."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(name.asc_nulls_last(), "v").limit(k).select("v").collect()  # k rows
    return np.array([r["v"] for r in rows], np.int64)


@dataclass(frozen=True)
class Simplex:
    """Pivots, and their corners in the plane they span: corner i has i coordinates that are not 0."""

    pivots: np.ndarray
    corners: np.ndarray

    @classmethod
    def over(cls, candidates: np.ndarray) -> Simplex:
        """Of those ``candidates`` that stand clear of the plane of the ones before; at least the first."""
        pivots, corners = [candidates[0]], np.zeros((1, 0))
        for c in candidates[1:]:
            apex = cls(np.array(pivots), corners).apexes(c[None, :])[0]
            away = np.sqrt(float(((c - candidates[0]) ** 2).sum()))
            if away and apex[-1] >= LEAST_HEIGHT * away:
                pivots.append(c)
                corners = np.vstack([np.column_stack([corners, np.zeros(len(corners))]), apex])
        return cls(np.array(pivots), corners)

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Coordinates over the plane and the height of each vector, from its distances to the pivots alone."""
        squares = squared_distances(vectors, self.pivots).astype(float)
        place = self.corners[1:]
        # |x - corner|^2 = d^2 for the first corner, 0, and each other one, subtracted: linear and triangular in x.
        right = (squares[:, :1] - squares[:, 1:] + (place ** 2).sum(axis=1)) / 2
        x = np.linalg.solve(place, right.T).T if len(place) else right
        height = np.sqrt(np.maximum(squares[:, 0] - (x ** 2).sum(axis=1), 0))
        return np.column_stack([x, height])


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact, as integers."""
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1)


def candidates(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """For each apex and each of the apexes ``centroids`` whether that centroid may be nearest."""
    plane = ((apexes[:, None, :-1] - centroids[None, :, :-1]) ** 2).sum(axis=2)
    a, b = apexes[:, None, -1], centroids[None, :, -1]
    slack = SLACK * ((apexes ** 2).sum(axis=1)[:, None] + (centroids ** 2).sum(axis=1).max())
    return plane + (a - b) ** 2 <= (plane + (a + b) ** 2).min(axis=1)[:, None] + slack


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, simplex: Simplex) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest centroid, squared distance, exact comparisons made); of equally near ones the smaller number."""
    near = candidates(apexes, simplex.apexes(centroids))
    best, number = np.full(len(vectors), np.iinfo(np.int64).max), np.zeros(len(vectors), np.int64)
    for k, centroid in enumerate(centroids):
        rows = np.flatnonzero(near[:, k])
        d = ((vectors[rows] - centroid) ** 2).sum(axis=1)
        less = d < best[rows]
        best[rows[less]], number[rows[less]] = d[less], k
    return number, best, int(near.sum())


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _projected(vectors: DataFrame, shared: Broadcast) -> DataFrame:
    """Rows (vec_id, v, apex) as packed 32-bit integers and doubles."""
    def project(batches):
        for b in batches:
            v = b["v"].flatten().to_numpy().reshape(b.num_rows, -1)
            packed = v.astype("<i4")
            yield pa.RecordBatch.from_arrays([
                b["vec_id"], pa.array([x.tobytes() for x in packed], pa.binary()), pa.array([x.tobytes() for x in shared.value.apexes(v)], pa.binary())], ["vec_id", "v", "apex"])

    return vectors.mapInArrow(project, "vec_id bigint, v binary, apex binary")


def _assigned(batches, shared: Broadcast):
    """(batch, vectors, cluster, distance) of each batch of stored rows."""
    simplex, centroids = shared.value
    for b in batches:
        v = _matrix(b["v"], centroids.shape[1], "<i4").astype(np.int64)
        if len(v):
            yield b, v, *nearest(v, _matrix(b["apex"], len(simplex.pivots), "<f8"), centroids, simplex)[:2]


def _moved(stored: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floored mean of their vectors; those without vectors stay."""
    k, width = centroids.shape
    shared = stored.sparkSession.sparkContext.broadcast((simplex, centroids))  # k vectors and pivots

    def sums(batches):
        total, n = np.zeros((k, width + 1), object), 0
        for _, v, cluster, _ in _assigned(batches, shared):
            rows = np.column_stack([v, np.ones(len(v), np.int64)])
            for c in np.unique(cluster):
                total[c] += rows[cluster == c].sum(axis=0)
            n += len(v)
        if n:
            c, place = (x.ravel().astype(np.int32) for x in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(place), pa.array(list(total.ravel()), pa.int64())], ["cluster", "place", "total"])

    parts = stored.select("v", "apex").mapInArrow(sums, "cluster int, place int, total bigint")
    rows = parts.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # k * (width + 1) rows
    shared.destroy()
    total = {(r["cluster"], r["place"]): int(r["total"]) for r in rows}
    out = centroids.copy()
    for c in range(k):
        if n := total.get((c, width), 0):
            out[c] = [total[c, i] // n for i in range(width)]
    return out


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
                    seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(rows (vec_id, cluster, distance), final centroids) of Lloyd's rounds on integer vectors.

    Of fewer than k vectors each is a centroid; of none there are no rows. Repeated rows and null ids are vectors like others.
    """
    kept = integer_vectors(vectors, id_col, vector_col, dimensions, scale)
    centroids = first_centroids(kept, k, seed)
    spark = vectors.sparkSession
    if not len(centroids):
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), np.zeros((0, dimensions), np.int64)
    simplex = Simplex.over(centroids)
    stored = materialise(_projected(kept, spark.sparkContext.broadcast(simplex)), "apexes")
    for _ in range(rounds):
        centroids = _moved(stored, simplex, centroids)
    shared = spark.sparkContext.broadcast((simplex, centroids))

    def label(batches):
        for b, _, cluster, distance in _assigned(batches, shared):
            yield pa.RecordBatch.from_arrays([b["vec_id"], pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return materialise(stored.mapInArrow(label, "vec_id bigint, cluster int, distance bigint"), "clusters"), centroids


def centroid_digests(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one per kept row of ``vectors``.

    Rows whose vector is null, of another length, or with null or non-finite components give none. Inertia is the sum of squared
    distances; one that exceeds a BIGINT is an error. For other cases see ``cluster_vectors`` and ``integer_vectors``.
    """
    rows, centroids = cluster_vectors(vectors, id_col, vector_col, **options)
    summed = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row per cluster
    total = sum(int(r["s"]) for r in summed)
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    table = [(r["cluster"], int(r["s"]), total, digest[r["cluster"]]) for r in summed]
    facts = rows.sparkSession.createDataFrame(table, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
