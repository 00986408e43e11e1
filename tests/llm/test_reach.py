"""Sets leave a block where the places of the shared shingle allow no link."""

import numpy as np

from tidemark.llm import jaccard


def test_partnered_as_in_all_pairs():
    rng = np.random.default_rng(7)
    for _ in range(300):
        sizes = rng.integers(1, 9, rng.integers(1, 6))
        n = int(sizes.sum())
        length = rng.integers(1, 40, n)
        reach = jaccard._reach(length, (rng.random(n) * (length // 4 + 1)).astype(np.int64))
        part = rng.integers(0, 4, n)
        block = np.repeat(np.arange(len(sizes)), sizes)
        meets = (block[:, None] == block) & (part[:, None] != part) & (length <= reach[:, None]) & (length[:, None] <= reach)
        assert (jaccard._partnered(sizes, length, reach, part) == meets.any(axis=1)).all()


def test_similar_sets_are_in_reach_at_their_first_shared_shingle():
    rng, similar = np.random.default_rng(3), 0
    for _ in range(3_000):
        whole = rng.permutation(60)
        x, y = (np.sort(whole[rng.random(60) < 0.93]) for _ in range(2))
        shared = np.intersect1d(x, y)
        if 100 * len(shared) < 75 * (len(x) + len(y) - len(shared)):
            continue
        similar += 1
        i, j = np.searchsorted(x, shared[0]), np.searchsorted(y, shared[0])
        assert len(y) <= jaccard._reach(np.int64(len(x)), i) and len(x) <= jaccard._reach(np.int64(len(y)), j)
    assert similar > 500


def test_points_are_stored_packed():
    for n in (40, 300, 3_000):
        shingles = np.random.default_rng(n).integers(0, 1 << 48, n).astype(np.uint64)
        stored = jaccard._point(shingles)
        point = jaccard._as_point(stored)
        assert (point == np.bincount((shingles % np.uint64(len(point))).astype(np.int64), minlength=len(point))).all()
        assert 5 * len(stored) < 3 * len(point)


def test_points_take_a_bit_for_each_group_and_shingle():
    for n in (1, 40, 300, 500, 3_000):
        shingles = np.random.default_rng(n).integers(0, 1 << 48, n).astype(np.uint64)
        stored = jaccard._point(shingles)
        point = jaccard._as_point(stored)
        assert point.sum(dtype=np.int64) == n and len(stored) == -(-(n + len(point)) // 8)
    one = np.full(200, 7 << 20, np.uint64)  # all in one group
    assert jaccard._as_point(jaccard._point(one)).max() == 200
