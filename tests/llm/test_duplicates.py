"""Exact and near duplicates against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import jaccard
from tidemark.llm.components import components, local_forest
from tidemark.llm.exact_dedup import exact_duplicates
from tidemark.llm.jaccard import jaccard_components
from tidemark.llm.rtree import candidate_pairs

UPPER = {i: i + 32 for i in range(65, 91)}


def groups(rows):
    by = defaultdict(list)
    for doc_id, text in rows:
        by[hashlib.sha256((text or "").translate(UPPER).encode()).hexdigest()].append(doc_id)
    return by


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_duplicates(odd, docs, keep):
    for frame in (odd, docs, docs.union(docs).repartition(37)):
        by = groups([(r["doc_id"], r["text"]) for r in frame.collect()])
        want, stays = Counter(), (max if keep == "largest" else min)
        for sha, ids in by.items():
            known = [i for i in ids if i is not None]
            best = (stays(known) if known and (keep == "largest" or None not in ids) else None)
            want.update((i, best, len(ids), sha) for i in ids)
        got = exact_duplicates(frame, keep=keep).collect()
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
        kept = [r for r in got if r["kept"]]
        assert Counter(r["text_sha256"] for r in kept) == Counter(by.keys()) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_exact_duplicates_of_nothing(none):
    assert exact_duplicates(none).count() == 0


def test_hot_text_over_many_tasks(spark):
    rows = spark.range(0, 6000, numPartitions=40).selectExpr("id AS doc_id", "if(id % 3 = 0, 'Hot', concat('t', id % 1500)) AS text")
    got = {r["doc_id"]: r for r in exact_duplicates(rows).collect()}
    assert len(got) == 6000 and got[0]["group_size"] == 2000 and got[0]["keep_id"] == 5997
    assert sum(r["kept"] for r in got.values()) == len({r["text_sha256"] for r in got.values()})


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.translate(UPPER).split(" ") if w]


def brute(rows):
    sets = []
    for _, text in rows:
        w = words_of(text or "")
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= 75 * (len(a) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        members[find(i)].append(doc_id)
    least = {root: min((x for x in ids if x is not None), default=None) for root, ids in members.items()}
    return Counter((doc_id, len(sets[i]), least[find(i)] if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows))


def near_copies(n, seed=1):
    """Families of near copies around the limit, a passage in many texts, and chains of small changes."""
    rng, rows = random.Random(seed), []
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    while len(rows) < n:
        base = [word() for _ in range(rng.choice([3, 5, 8, 30, 60, 120]))]
        if rng.random() < 0.4:
            at = rng.randrange(len(base))
            base[at:at] = passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            rows.append((len(rows), " ".join(base)))
            base = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                base[rng.randrange(len(base))] = word()
    return rows[:n]


def as_counter(frame):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in frame.collect())


def test_jaccard_components(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert as_counter(jaccard_components(odd)) == brute(rows)
    rows = near_copies(350)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert as_counter(jaccard_components(frame)) == brute(rows)


def test_frequent_shingles_and_split_blocks(spark, monkeypatch):
    """Shingles that many sets hold, in blocks of several parts."""
    rows = near_copies(300, seed=2)
    rng = random.Random(5)
    base = [f"h{i}" for i in range(80)]
    for k in range(120):
        near = list(base)
        near[rng.randrange(80)] = f"z{k}"
        rows.append((len(rows), " ".join(near)))
    for k in range(40):  # the same first 50 words, unlike in the rest: not linked
        rows.append((len(rows), " ".join(base[:50] + [f"y{k}_{i}" for i in range(30)])))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2)
    assert as_counter(jaccard_components(frame, block_sets=25)) == brute(rows)


def test_jaccard_of_nothing(none):
    assert jaccard_components(none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(2, 150))
def test_tree_lets_all_similar_pairs_pass(seed, n):
    rng = np.random.default_rng(seed)
    sets = [set(rng.integers(0, 60, rng.integers(1, 40)).tolist()) for _ in range(n)]
    points = np.array([np.bincount(np.array(list(s)) % 16, minlength=16) for s in sets]).astype(np.uint16)
    parts = rng.integers(0, 5, n)
    i, j = candidate_pairs(points, points.sum(axis=1), parts)
    found = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
    for a in range(n):
        for b in range(a + 1, n):
            shared = len(sets[a] & sets[b])
            if parts[a] != parts[b] and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                assert (a, b) in found
    assert all(parts[a] != parts[b] for a, b in found)


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)] + [(200, 201), (201, 202), (202, 200)]
    links = [(a, b) for a, b in links if a != b]
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent}
    frame = spark.createDataFrame(links, "a bigint, b bigint").repartition(7)
    assert {r["node"]: r["component"] for r in components(frame).collect()} == want
    node, root = local_forest(np.array([a for a, _ in links]), np.array([b for _, b in links]))
    assert dict(zip(node.tolist(), root.tolist())) == {x: r for x, r in want.items() if x != r}
    assert components(frame.limit(0)).count() == 0


def test_shingles_are_told_apart():
    words = np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64)
    assert len(jaccard.shingle_hashes(words)) == 4996
    assert len(jaccard.shingle_hashes(words[:4])) == 1 and len(jaccard.shingle_hashes(words[:0])) == 0
