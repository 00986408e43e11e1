import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import centroids as ce

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, k=8, rounds=10, seed=3, dimensions=64):
    """Lloyd's rounds in plain integers, every vector against every centroid."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(kept, found) if c == n]
            if mine:
                centres[n] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    inertia = {n: sum(d for d, c in found if c == n) for n in range(len(centres))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), sha[n]) for (i, _), (d, n) in zip(kept, found)), key=repr)


def _rows(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


def test_given_vectors(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert _rows(ce.centroid_digests(vectors)) == brute(rows)


def _odd():
    rng = np.random.default_rng(7)
    same = rng.normal(size=64).astype(np.float32).tolist()
    rows = [(i, same) for i in range(300)] + [(1000 + i, rng.normal(size=64).astype(np.float32).tolist()) for i in range(60)]
    rows += [(5, same), (5, same), (None, same), (None, [0.5] * 64), (7, [-0.25] * 64), (8, None), (9, []), (10, [1.0] * 63), (11, [1.0] * 65),
             (12, [None] + [1.0] * 63), (13, [float("nan")] + [1.0] * 63), (14, [float("inf")] + [1.0] * 63), (15, [float("-inf")] + [1.0] * 63)]
    return rows


def test_copies_nulls_ties_and_other_columns(spark):
    from pyspark.sql import functions as F

    rows = _odd()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("clash") for c in ("v", "x", "apex", "cluster", "distance", "place", "total", "label")})
    assert _rows(ce.centroid_digests(frame)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(3, [1.0] * 64)], [(i, [float(i % 2)] * 64) for i in range(20)], [(1, None)]])
def test_few_vectors(spark, rows):
    assert _rows(ce.centroid_digests(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_too_large_a_component_is_an_error(spark):
    frame = spark.createDataFrame([(1, [1e30] * 64)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        ce.centroid_digests(frame).collect()


@pytest.mark.parametrize("width", [2, 5, 64])
def test_bounds_hold_and_filter(width):
    rng = np.random.default_rng(width)
    centres = rng.integers(-3000, 3000, (8, width))
    vectors = np.concatenate([c + rng.integers(-150, 150, (200, width)) for c in centres])
    simplex = ce.Simplex.over(centres)
    apexes, moved = simplex.apexes(vectors), centres + rng.integers(-100, 100, (8, width))
    theirs, true = simplex.apexes(moved), np.sqrt(ce.squared_distances(vectors, moved).astype(float))
    plane = ((apexes[:, None, :-1] - theirs[None, :, :-1]) ** 2).sum(axis=2)
    low, high = np.sqrt(plane + (apexes[:, None, -1] - theirs[:, -1]) ** 2), np.sqrt(plane + (apexes[:, None, -1] + theirs[:, -1]) ** 2)
    assert (low <= true * (1 + 1e-9) + 1e-3).all() and (true <= high * (1 + 1e-9) + 1e-3).all()
    number, distance, compared = ce.nearest(vectors, apexes, moved, simplex)
    assert (distance == ce.squared_distances(vectors, moved).min(axis=1)).all()
    assert (number == ce.squared_distances(vectors, moved).argmin(axis=1)).all()
    assert compared < 0.3 * vectors.shape[0] * 8
