"""Benchmark decontamination by winnowing: words of documents that stand in a benchmark's ten-word windows; exact.

Fingerprints are k-gram hashes; of every w neighbouring k-grams the least is kept (the rightmost of equal ones). With
k + w - 1 = WINDOW such a neighbourhood is a window of WINDOW words, and what is kept depends on its words alone, so a window
that a document shares with an item gives both the same fingerprint. An item of fewer words, m, is one window: there k = m and w = 1.

1. Items give a table of windows (fingerprint, window, item), and a bit filter of their fingerprints of bounded size.
2. One pass over the documents stores their sizes, and the fingerprints that the filter lets pass, each with the windows it was kept for.
3. Fingerprints are joined with those of the items, hits extended to their windows, and these joined with the items' windows.
4. Hit words are the union of the spans, by a window function along each document.
5. Documents that hit the same windows share one list of items, made once and digested as a stream.

Words are compared by 64-bit hashes, windows by two 64-bit hashes of those.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import fresh_path, materialise
from .common import id_and_text, slices, trimmed

#: Words of a window, and of a k-gram inside it.
WINDOW, GRAM = 10, 5
#: Bits of the filter: 64 per fingerprint, but no more than these; a fuller filter lets more pass to the join and loses nothing.
FILTER_BITS = 1 << 27
#: Words that a task remembers.
KNOWN_WORDS = 500_000

_WORDS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def words_of(text: str) -> list[bytes]:
    """Words in UTF-8: A-Z lower-cased, split at every other ASCII character that is no letter or digit."""
    return text.encode().translate(_WORDS).split()


class WordHashes:
    """64-bit hashes of the words of texts; one per task, remembers words."""

    def __init__(self):
        self._known: dict[bytes, int] = {}

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, number of words of each text)."""
        known, words = self._known, [words_of(t) for t in texts]
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in set().union(*words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        hashes = np.fromiter((known[w] for some in words for w in some), np.uint64, int(sizes.sum()))
        return hashes, sizes


def grams(words: np.ndarray, k: int, mix: np.uint64 = _MIX[0]) -> np.ndarray:
    """Hash of the k words from each place on; none for the last k - 1."""
    n = max(len(words) - k + 1, 0)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = (h ^ (h >> np.uint64(29))) * mix + words[i:i + n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def gram_size(width: int) -> int:
    return GRAM if width == WINDOW else width


def window_starts(sizes: np.ndarray, width: int) -> np.ndarray:
    """For each place among all words, whether ``width`` words of the same text begin there."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    return np.arange(len(ends)) + width <= ends


def kept_grams(words: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, its place) of the window of ``width`` words from each place on, the rightmost of equal least k-grams."""
    h = grams(words, k)
    n = max(len(words) - width + 1, 0)
    least, place = h[:n].copy(), np.arange(n)
    for i in range(1, width - k + 1):
        other = h[i:i + n]
        less = other <= least
        np.copyto(least, other, where=less)
        np.copyto(place, np.arange(i, i + n), where=less)
    return least, place


def _item_windows(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct (width, gram, high, low, item): each window of each item with its fingerprint."""
    def read(batches):
        hashes = WordHashes()
        for b in (part for whole in batches for part in slices(whole)):
            words, sizes = hashes(b["text"].to_pylist())
            width, of_word = np.minimum(sizes, WINDOW), np.repeat(np.arange(len(sizes)), sizes)
            for m in np.unique(width[width > 0]):
                m = int(m)
                at = np.flatnonzero(window_starts(sizes, m) & (width[of_word] == m))
                gram = kept_grams(words, gram_size(m), m)[0][at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), m, np.int32)), pa.array(gram.view(np.int64)), pa.array(grams(words, m)[at].view(np.int64)),
                     pa.array(grams(words, m, _MIX[1])[at].view(np.int64)), b["item"].take(pa.array(of_word[at]))], ["width", "gram", "high", "low", "item"])

    rows = items.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    schema = "width int, gram bigint, high bigint, low bigint, item string"
    return rows.mapInArrow(lambda batches: trimmed(read(batches)), schema).distinct()


def bit_filter(spark: SparkSession, hashes: DataFrame, column: str, most_bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap with bit ``hash mod bits`` set for every row; of ``most_bits`` at most, which bounds what comes to the driver."""
    bits = 1 << 16
    while bits < min(most_bits, 64 * hashes.count()):
        bits *= 2
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    marked = hashes.select(F.shiftrightunsigned(place, 6).alias("word"), F.expr(f"shiftleft(1L, CAST({column} & 63 AS INT))").alias("bit"))
    rows = marked.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(64 * len(bitmap) - 1)
    words = bitmap.view(np.uint64)[(place >> np.uint64(6)).astype(np.int64)]
    return (words >> (place & np.uint64(63))) & np.uint64(1) == 1


_SCAN = "kind int, row bigint, doc_id bigint, n_words bigint, width int, gram bigint, starts array<int>, highs array<bigint>, lows array<bigint>"


def _scanned(docs: DataFrame, widths: list[int], bitmap: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """Stored rows: of each document its size (kind 0), and each of its fingerprints that the filter lets pass, with the windows it is kept for (kind 1)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bitmap)  # FILTER_BITS at most

    def hits(words, sizes, row):
        heads = np.cumsum(sizes) - sizes
        of_word = np.repeat(np.arange(len(sizes)), sizes)
        for m in widths:
            if len(words) < m:
                continue
            gram, place = kept_grams(words, gram_size(m), m)
            at = np.flatnonzero(passes(shared.value, gram) & window_starts(sizes, m)[:len(gram)])
            if not len(at):
                continue
            high, low = (grams(words, m, mix)[at].view(np.int64) for mix in _MIX)
            doc, kept = of_word[at], gram[at]
            # Windows of one occurrence follow each other; where an item is one window, its repeats in a document make one row.
            order = np.lexsort([at, place[at], doc]) if m == WINDOW else np.lexsort([at, low, high, doc])
            at, high, low, doc, kept, same = at[order], high[order], low[order], doc[order], kept[order], place[at][order]
            new = (same[1:] != same[:-1]) if m == WINDOW else (high[1:] != high[:-1]) | (low[1:] != low[:-1])
            first = np.flatnonzero(np.append(True, new | (doc[1:] != doc[:-1])))
            cuts = pa.array(np.append(first, len(at)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in ((at - heads[doc]).astype(np.int32), high, low)]
            n = len(first)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, 1, np.int32)), row.take(pa.array(doc[first])), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                pa.array(np.full(n, m, np.int32)), pa.array(kept[first].view(np.int64)), *lists], _COLUMNS)

    def read(batches):
        hashes = WordHashes()
        for b in (part for whole in batches for part in slices(whole)):
            words, sizes = hashes(b["text"].to_pylist())
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(n, np.int32)), b["row"], b["doc_id"], pa.array(sizes), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()),
                pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], _COLUMNS)
            yield from hits(words, sizes, b["row"])

    path = fresh_path(spark, "fingerprints")
    rows = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    rows.mapInArrow(lambda batches: trimmed(read(batches)), _SCAN).write.partitionBy("kind").parquet(path)
    return spark.read.schema(_SCAN).option("basePath", path).parquet(path)


_COLUMNS = ["kind", "row", "doc_id", "n_words", "width", "gram", "starts", "highs", "lows"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def _signature(*columns: str) -> list[Column]:
    """Count and two sums over distinct rows: equal for equal sets, whatever their order, and merged like any sum."""
    sums = [F.sum(F.xxhash64(*columns, F.lit(seed)).cast("decimal(38,0)")).alias(name) for seed, name in ((1, "sum1"), (2, "sum2"))]
    return [F.count("*").alias("n_windows"), *sums]


def _item_lists(found: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((row, pattern keys), (pattern keys, n_items, items_sha256)): documents that hit the same windows have the same items."""
    keys = ["n_windows", "sum1", "sum2"]
    distinct = found.select("row", "width", "high", "low").distinct()
    patterns = materialise(distinct.groupBy("row").agg(*_signature("width", "high", "low")), "patterns")
    chosen = patterns.groupBy(*keys).agg(F.min("row").alias("row"))
    listed = distinct.join(chosen, "row").join(windows.select("width", "high", "low", "item"), ["width", "high", "low"])
    listed = listed.filter("item IS NOT NULL").select("row", "item").distinct()

    def digest(batches):
        def pairs():
            for b in batches:
                yield from zip(b["row"].to_pylist(), b["item"].to_pylist())

        for row, items in groupby(pairs(), key=lambda p: p[0]):
            sha, n = hashlib.sha256(), 0
            for _, item in items:
                sha.update(b"," * (n > 0) + item.encode())
                n += 1
            yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([n], pa.int64()), pa.array([sha.hexdigest()])], ["row", "n_items", "items_sha256"])

    sums = listed.repartition("row").sortWithinPartitions("row", "item").mapInArrow(digest, "row bigint, n_items bigint, items_sha256 string")
    return patterns, chosen.join(sums, "row").select(*keys, "n_items", "items_sha256")


def contamination_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                        item_text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, spans, windows): rows (row, doc_id, n_words); (row, start, width, high, low), a row per window of a
    document that some item has, ``start`` in words; and the items' windows (width, gram, high, low, item)."""
    windows = materialise(_item_windows(items, item_col, item_text_col), "windows")
    widths = [r[0] for r in windows.select("width").distinct().orderBy("width").collect()]  # 1 to WINDOW
    fingerprints = windows.select("gram").distinct()
    scanned = _scanned(docs, widths, bit_filter(docs.sparkSession, fingerprints, "gram"), id_col, text_col)
    hits = scanned.filter("kind = 1").join(fingerprints, "gram", "left_semi")
    spans = hits.select("row", "width", F.explode(F.arrays_zip("starts", "highs", "lows")).alias("s")).select(
        "row", "width", F.col("s.starts").alias("start"), F.col("s.highs").alias("high"), F.col("s.lows").alias("low"))
    known = windows.select("width", "high", "low").distinct()
    found = materialise(spans.join(known, ["width", "high", "low"], "left_semi"), "spans")
    return scanned.filter("kind = 0").select("row", "doc_id", "n_words"), found, windows


def contaminated_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                           item_text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one per row of ``docs``.

    A window is 10 neighbouring words of an item, or all words of an item with fewer. A word inside any occurrence of a
    window is hit. Null and empty texts have no words; items without words have no window. Repeated rows each give a row, as do null ids.
    An item whose id repeats counts once; items with a null id make words hit but are not listed. The digest of no items is that of the empty string.
    """
    rows, found, windows = contamination_spans(docs, items, id_col, text_col, item_col, item_text_col)
    along = Window.partitionBy("row").orderBy("start", "width")
    end = F.col("start") + F.col("width")
    before = F.coalesce(F.max(end).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = found.select("row", F.greatest(F.lit(0), end - F.greatest("start", before)).alias("fresh"))
    counted = fresh.groupBy("row").agg(F.sum("fresh").cast("bigint").alias("n_hit"))
    patterns, lists = _item_lists(found, windows)
    keys = ["n_windows", "sum1", "sum2"]
    named = patterns.join(lists, keys, "left").select("row", "n_items", "items_sha256")
    return rows.join(counted, "row", "left").join(named, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.lit(_EMPTY)).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
