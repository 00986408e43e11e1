import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import common, winnowing as wi

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
_WORD = re.compile("[^\\x00-\\x2f\\x3a-\\x60\\x7b-\\x7f]+")


def _words(text):
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, width=10):
    """Every window of every document looked up in a dictionary of windows."""
    windows = {}
    for item, text in items:
        w = _words(text)
        m = min(width, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[i:i + m]), set()).add(item)
    sizes, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        w, hit, found = _words(text), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in windows:
                    hit.update(range(i, i + m))
                    found |= windows[tuple(w[i:i + m])]
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def _rows(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


def _check(spark, docs, items, item_type="bigint"):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    i = spark.createDataFrame(items, f"item_id {item_type}, text string").repartition(2)
    got = _rows(wi.contaminated_documents(d, i))
    assert got == brute(docs, items)
    return got


def test_given_tables(spark, docs, sf):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    expected = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert _rows(wi.contaminated_documents(docs, items)) == expected and any(r[5] for r in expected)


def test_few_words_make_many_hits(spark):
    """A vocabulary of two or three words: repeats, ties among k-grams, overlaps of all kinds, and items of 0 to 14 words."""
    rng = random.Random(2)
    text = lambda n, v: " ".join(rng.choice("ab c7 É".split()[:v]) for _ in range(n))
    items = [(i, text(i % 15, 2 + i % 2)) for i in range(60)] + [(3, text(12, 3)), (None, text(11, 3)), (4, None), (5, "-- ,"), (70, "AB. ab! c7")]
    docs = [(i, text(rng.randrange(0, 60), 3)) for i in range(150)] + [(200, None), (201, ""), (7, text(50, 3)), (None, text(50, 3)), (202, text(4000, 3))]
    assert any(r[2] for r in _check(spark, docs, items, "string"))


def test_long_windows_only(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["aa", "bb", "cc"])
    items = [(i, " ".join(word() for _ in range(10 + i % 7))) for i in range(25)]
    texts = [" ".join(word() for _ in range(300)) for _ in range(20)] + [" x ".join(t for _, t in items), items[3][1][1:], "Zz " + items[2][1].upper() + "!"]
    _check(spark, list(enumerate(texts)), items)


def test_many_documents_and_items_of_one_passage(spark, many_ranges):
    passage = " ".join(f"w{i}" for i in range(40))
    items = [(i, f"{passage} end{i}") for i in range(300)]
    docs = [(i, f"before{i} {passage} after") for i in range(2000)] + [(5000, "nothing here")]
    got = _check(spark, docs, items)
    assert {r[2] for r in got} == {0, 40}


def test_no_items_no_documents(spark, none, odd):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert {(r["n_hit"], r["n_items"], r["contaminated"]) for r in wi.contaminated_documents(odd, empty).collect()} == {(0, 0, False)}
    assert wi.contaminated_documents(none, empty).count() == 0


def test_odd_rows(spark, odd):
    items = [(1, "Released under the MIT License"), (2, "wörd1 token1 wörd2 token2 wörd3 token3 wörd4 token4 wörd5 token5 wörd6"), (3, "one")]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    assert _rows(wi.contaminated_documents(odd, frame)) == brute([(r["doc_id"], r["text"]) for r in odd.collect()], items)


@pytest.mark.parametrize("vocabulary", [1, 2, 50])
def test_shared_windows_share_a_fingerprint(vocabulary):
    """What is kept of a window depends on its words alone, wherever it stands."""
    rng = np.random.default_rng(vocabulary)
    words = rng.integers(0, vocabulary, 500).astype(np.uint64)
    least, place = wi.kept_grams(words, wi.GRAM, wi.WINDOW)
    for i in range(0, 490, 7):
        alone, at = wi.kept_grams(words[i:i + wi.WINDOW], wi.GRAM, wi.WINDOW)
        assert alone.tolist() == [least[i]] and at[0] + i == place[i]


def test_a_full_filter_loses_nothing(spark):
    hashes = spark.range(5000).selectExpr("xxhash64(id) AS gram")
    bitmap = wi.bit_filter(spark, hashes, "gram", most_bits=1 << 16)
    values = hashes.toArrow()["gram"].to_numpy().view(np.uint64)
    assert wi.passes(bitmap, values).all() and len(bitmap) == 1 << 10
    others = np.random.default_rng(1).integers(0, 1 << 62, 10_000).astype(np.uint64)
    assert wi.passes(bitmap, others).mean() < 0.1


def test_slices_follow_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * (3 << 20), "y", None, "z" * (9 << 20), "", "w" * (3 << 20)])], ["text"])
    assert [s.num_rows for s in common.slices(batch)] == [3, 1, 2] and sum(s.num_rows for s in common.slices(batch.slice(0, 0))) == 0
