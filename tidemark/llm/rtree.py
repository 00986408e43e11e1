"""An R-tree over count vectors, joined with itself.

A point is the vector of a set's element counts in hash groups. Two sets share at most the sum over groups
of the smaller count; a node bounds the counts below it by their maxima, so the same sum over node maxima
bounds every pair below two nodes.
"""

from __future__ import annotations

import numpy as np

#: Points of a leaf, and nodes under a node.
FAN = 32


def needs(a, b):
    """7 * overlap that sets of sizes a and b need at least for a Jaccard similarity of 0.75."""
    return 3 * (a + b)


def _levels(points: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(maxima, smallest size, largest size) per node, from the leaves up; leaves are FAN points in order."""
    starts = np.arange(0, len(points), FAN)
    level = (np.maximum.reduceat(points, starts), np.minimum.reduceat(sizes, starts), np.maximum.reduceat(sizes, starts))
    levels = [level]
    while len(levels[-1][0]) > 1:
        maxima, low, high = levels[-1]
        starts = np.arange(0, len(maxima), FAN)
        levels.append((np.maximum.reduceat(maxima, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)))
    return levels


def _overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a[:, None, :], b[None, :, :]).sum(axis=2, dtype=np.int64)


def candidate_pairs(points: np.ndarray, sizes: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of all pairs of different ``parts`` that the bounds let pass; a superset of the similar ones."""
    found = [np.zeros((2, 0), np.int64), *map(np.stack, leaf_pairs(points, sizes, parts))]
    return tuple(np.concatenate(found, axis=1))


def leaf_pairs(points: np.ndarray, sizes: np.ndarray, parts: np.ndarray):
    """The pairs (i, j) of each leaf with itself and those after it, leaf by leaf.

    ``points`` are counts, ``sizes`` their sums. Leaves are filled in order of size, then of the
    heaviest group, so that sizes of a leaf are close.
    """
    order = np.lexsort([points.argmax(axis=1), sizes])
    points, sizes, parts = points[order], sizes[order].astype(np.int64), parts[order]
    levels = _levels(points, sizes)
    leaves = len(levels[0][0])
    for leaf in range(leaves):
        mine = slice(leaf * FAN, (leaf + 1) * FAN)
        top, low, high = (x[leaf] for x in levels[0])
        nodes = np.zeros(1, np.int64)
        for depth in range(len(levels) - 1, -1, -1):
            maxima, small, large = levels[depth]
            last = (nodes + 1) * FAN ** depth - 1  # the last leaf below
            keep = (last >= leaf) & (4 * high >= 3 * small[nodes]) & (4 * large[nodes] >= 3 * low)
            nodes = nodes[keep]
            bound = np.minimum(maxima[nodes], top).sum(axis=1, dtype=np.int64)
            nodes = nodes[7 * bound >= needs(low, small[nodes])]
            if depth:
                below = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
                nodes = below[below < len(levels[depth - 1][0])]
        found: list[tuple] = []
        for other in nodes[nodes >= leaf]:
            theirs = slice(other * FAN, (other + 1) * FAN)
            shared = _overlaps(points[mine], points[theirs])
            a, b = sizes[mine][:, None], sizes[theirs][None, :]
            good = (7 * shared >= needs(a, b)) & (4 * np.minimum(a, b) >= 3 * np.maximum(a, b))
            good &= parts[mine][:, None] != parts[theirs][None, :]
            i, j = np.nonzero(good)
            i, j = i + leaf * FAN, j + other * FAN
            ahead = i < j
            found.append((order[i[ahead]], order[j[ahead]]))
        if found:
            yield tuple(map(np.concatenate, zip(*found)))
