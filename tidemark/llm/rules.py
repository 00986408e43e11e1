"""Quality rules with an isolation forest on what the rules measure.

The measures of a text are exact counts. A forest of random splits, each tree of which draws its rows from all documents, gives each
document the mean length of its paths; short paths mean few documents are like it. How short is too short is set
on all labelled rows, for each measure that can make a document odd: the threshold that finds most bad ones among those
that reject at most ``spare`` of the good ones. (An odd share of symbols marks junk; one repeated line seldom does.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.quantiles import exact_quantiles
from ..operators.ranking import with_global_rank
from ..session import materialise
from .common import id_and_text

SYMBOLS = b"#*$%&|<>"
#: Words of a window that counts as repeated.
REPEAT_WINDOW = 3
#: Documents below or above these fail without the forest.
FEWEST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Trees, and the rows that each draws for itself from all documents: an isolation forest's own subsampling.
TREES, TREE_ROWS = 200, 256
#: Share of good labelled rows that the threshold may reject.
SPARE = 0.001

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_capitals"]
_SCHEMA = "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES)
_NOT_SYMBOLS = bytes(b for b in range(256) if b not in SYMBOLS)
_NOT_MARKS = bytes(b for b in range(256) if b >= 128 or chr(b).isalnum() or chr(b) in ".,'\"- \t\n\r\v\f")
_NOT_CAPITALS = bytes(b for b in range(256) if not 65 <= b <= 90)
_CONTINUES = bytes(range(0x80, 0xC0))


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of REPEAT_WINDOW words found at least twice, every place counted."""
    n = len(words) - REPEAT_WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    window = ids[:n]
    for k in range(1, REPEAT_WINDOW):
        # Numbers stay small: each step renames the pairs that occur.
        window = np.unique(window * len(number) + ids[k:k + n], return_inverse=True)[1]
    twice = np.bincount(window)[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(REPEAT_WINDOW):
        covered[k:k + n] |= twice
    return int(covered.sum())


def measure_text(text: str) -> tuple[int, ...]:
    """MEASURES of a text: also its ASCII marks other than usual punctuation, and its capitals A-Z."""
    data = text.encode()
    words = data.split()  # bytes split at ASCII white space only
    lines = [line for line in data.split(b"\n") if line.strip()]
    joined = b"".join(words)
    return (len(words), len(joined.translate(None, _CONTINUES)), len(data.translate(None, _NOT_SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words),
            len(data.translate(None, _NOT_MARKS)), len(data.translate(None, _NOT_CAPITALS)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, MEASURES), one per row of ``docs``.

    Words are split at ASCII white space; a null or empty text has none and measures 0 throughout.
    """
    def measure(batches):
        for b in batches:
            rows = np.array([measure_text(t) for t in b["text"].to_pylist()], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([b["doc_id"], *(pa.array(np.ascontiguousarray(rows[:, i])) for i in range(len(MEASURES)))], ["doc_id", *MEASURES])

    return id_and_text(docs, id_col, text_col).mapInArrow(measure, _SCHEMA)


def features(table) -> np.ndarray:
    """Shares that do not depend on the length of a text, from a table of MEASURES."""
    n, chars, *others = (table[m].to_numpy().astype(float) for m in MEASURES)
    n = np.maximum(n, 1)
    return np.stack([np.log(chars / n + 1), *(np.log1p(100 * x / n) for x in others)], axis=1)


def _usual_path(n: np.ndarray | float) -> np.ndarray | float:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n, 1.0)


class IsolationForest:
    """Random trees as arrays; ``paths`` gives the mean path length of each row, small for the unusual."""

    def __init__(self, rows: np.ndarray, seed: int = 7, trees: int = TREES, tree_rows: int = TREE_ROWS):
        rng = np.random.default_rng(seed)
        self.trees = [self._grow(rows[rng.choice(len(rows), min(tree_rows, len(rows)), replace=False)], rng) for _ in range(trees)]

    @classmethod
    def of(cls, draws: list[np.ndarray], seed: int = 7) -> "IsolationForest":
        """A tree for each of ``draws``."""
        forest, rng = cls.__new__(cls), np.random.default_rng(seed)
        forest.trees = [cls._grow(rows, rng) for rows in draws]
        return forest

    @staticmethod
    def _grow(rows: np.ndarray, rng) -> tuple:
        column, cut, child, length = [], [], [], []
        limit = int(np.ceil(np.log2(max(len(rows), 2))))
        waiting = [(rows, 0)]
        # Nodes are numbered as they are taken; the children of a split are the next two places of the queue.
        for part, depth in waiting:
            low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (0, 0)
            wide = np.flatnonzero(np.asarray(high) > np.asarray(low))
            if depth >= limit or not len(wide):
                column.append(-1)
                cut.append(0.0)
                child.append(0)
                length.append(depth + (float(_usual_path(len(part))) if len(part) > 1 else 0.0))
                continue
            c = int(rng.choice(wide))
            at = float(rng.uniform(low[c], high[c]))
            column.append(c)
            cut.append(at)
            child.append(len(waiting))
            length.append(0.0)
            waiting += [(part[part[:, c] < at], depth + 1), (part[part[:, c] >= at], depth + 1)]
        return tuple(map(np.array, (column, cut, child, length)))

    def paths(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        for column, cut, child, length in self.trees:
            node = np.zeros(len(rows), np.int64)
            while len(inner := np.flatnonzero(column[node] >= 0)):
                at = node[inner]
                node[inner] = child[at] + (rows[inner, column[at]] >= cut[at])
            total += length[node]
        return total / max(len(self.trees), 1)


def oddest(rows: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The measure by which each row lies farthest from the centre."""
    return np.argmax(np.abs(rows - centre) / scale, axis=1) if len(rows) else np.zeros(0, np.int64)


def calibrated(paths: np.ndarray, good: np.ndarray, spare: float = SPARE) -> float:
    """Paths below the result are anomalous: the largest threshold that rejects at most ``spare`` of the good rows.

    It lies midway between the last bad row that it catches and that limit. Without bad or good rows nothing is anomalous.
    """
    kept, bad = np.sort(paths[good]), paths[~good]
    if not len(kept):
        return 0.0
    limit = kept[int(spare * len(kept))]
    caught = bad[bad < limit]
    return float((caught.max() + limit) / 2) if len(caught) else 0.0


def thresholds(paths: np.ndarray, cause: np.ndarray, good: np.ndarray, groups: int, spare: float = SPARE) -> np.ndarray:
    """``calibrated`` for each oddest measure. Bad rows odd by a measure that no good row is odd by are all anomalous,
    so there the threshold lies just above the longest path of them."""
    out = np.zeros(groups)
    for c in range(groups):
        mine = cause == c
        bad = paths[mine & ~good]
        only_bad = len(bad) and good.any() and not good[mine].any()
        out[c] = np.nextafter(bad.max(), np.inf) if only_bad else calibrated(paths[mine], good[mine], spare)
    return out


_FEATURES = [f"f{i}" for i in range(len(MEASURES) - 1)]
_AS_DOUBLES = ", ".join(f"{f} double" for f in _FEATURES)


def _columns(rows: np.ndarray) -> list[pa.Array]:
    return [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(rows.shape[1])]


def tree_draws(passed: DataFrame, n: int, trees: int = TREES, tree_rows: int = TREE_ROWS) -> list[np.ndarray]:
    """For each tree the features of the ``tree_rows`` rows of ``passed``, which has ``n``, that come first under a hash order of its own.

    A row leaves its task for the trees where it is among the first by expectation, with twice the rows that are needed.
    """
    limit = np.uint64(min(2 * tree_rows / max(n, 1), 1.0) * (2**64 - 2**12))
    salts = np.random.default_rng(11).integers(0, 2**64, trees, np.uint64)

    def drawn(batches):
        for b in batches:
            rows, mark = features(b), b["mark"].to_numpy().view(np.uint64)
            found = []
            for tree, salt in enumerate(salts):
                key = (mark ^ salt) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(32)
                key *= np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
                at = np.flatnonzero(key <= limit) if n > 2 * tree_rows else np.arange(len(key))
                found.append((np.full(len(at), tree, np.int32), (key[at] >> np.uint64(1)).astype(np.int64), at))
            tree, key, at = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(key), *_columns(rows[at])], ["tree", "key", *_FEATURES])

    marked = passed.select(*MEASURES, F.xxhash64("doc_id", *MEASURES).alias("mark"))
    first = Window.partitionBy("tree").orderBy("key", *_FEATURES)
    ranked = marked.mapInArrow(drawn, f"tree int, key bigint, {_AS_DOUBLES}").withColumn("place", F.row_number().over(first))
    table = ranked.filter(F.col("place") <= tree_rows).orderBy("tree", "place").toArrow()  # trees * tree_rows rows: the model's own
    tree, rows = table["tree"].to_numpy(), np.stack([table[f].to_numpy() for f in _FEATURES], axis=1)
    return [rows[tree == t] for t in range(trees)]


def centre_and_scale(passed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Median and standard deviation of every feature, of all rows."""
    def turned(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(_columns(features(b)), _FEATURES)

    stored = materialise(passed.select(*MEASURES).mapInArrow(turned, _AS_DOUBLES), "features")
    medians = exact_quantiles(stored, _FEATURES, [0.5]).first()
    spread = stored.agg(*[F.stddev_pop(f).alias(f) for f in _FEATURES]).first()
    return np.array([medians[f][0] for f in _FEATURES]), np.array([spread[f] for f in _FEATURES]) + 1e-9


def labelled_thresholds(rated: DataFrame, groups: int, spare: float = SPARE) -> np.ndarray:
    """``thresholds`` of all rows (path, cause, good) of ``rated``; what comes to the driver is a few numbers per cause."""
    out = np.zeros(groups)
    per = {r["cause"]: r for r in rated.groupBy("cause").agg(F.count_if("good").alias("n"), F.max(F.when(~F.col("good"), F.col("path"))).alias("bad")).collect()}
    before, targets = 0, {}
    for c in sorted(per):
        if per[c]["n"]:
            targets[before + int(spare * per[c]["n"])] = c
            before += per[c]["n"]
    if not targets:
        return out
    ranked = with_global_rank(rated.filter("good").select("cause", "path"), [F.col("cause"), F.col("path")])
    limits = {targets[r["rank"]]: r["path"] for r in ranked.filter(F.col("rank").isin(list(targets))).collect()}
    below = [F.max(F.when(~F.col("good") & (F.col("cause") == c) & (F.col("path") < limit), F.col("path"))).alias(f"c{c}") for c, limit in limits.items()]
    caught = rated.agg(*below).first()
    for c in per:
        if c not in limits:
            out[c] = np.nextafter(per[c]["bad"], np.inf)
        elif caught[f"c{c}"] is not None:
            out[c] = (caught[f"c{c}"] + limits[c]) / 2
    return out


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """Rows (doc_id, MEASURES, base_failed, path, kept), one per row of ``docs``.

    ``base_failed``: fewer than FEWEST_WORDS words, or more than MOST_REPEATED_PERCENT percent of them repeated. Others are kept unless
    their path is below the threshold of their oddest measure. ``labels`` has id and ``label_col`` (1 good, 0 bad, null: ignored). With no usable labels or no documents
    that pass the base rules nothing is anomalous. Every document that passes may be drawn by every tree, all of them give centre and
    scale, and all labelled ones the thresholds.
    """
    base = materialise(measures(docs, id_col, text_col), "measures").withColumn(
        "base_failed", (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))
    passed = base.filter("NOT base_failed")
    n = passed.count()
    if not n:
        return base.withColumns({"path": F.lit(0.0), "kept": ~F.col("base_failed")})
    centre, scale = centre_and_scale(passed)
    shared = docs.sparkSession.sparkContext.broadcast((IsolationForest.of(tree_draws(passed, n)), centre, scale))

    def rate(batches):
        for b in batches:
            forest, centre, scale = shared.value
            rows = features(b)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forest.paths(rows)), pa.array(oddest(rows, centre, scale), pa.int32())], [*b.schema.names, "path", "cause"])

    rated = materialise(base.mapInArrow(rate, f"{_SCHEMA}, base_failed boolean, path double, cause int"), "paths")
    chosen = labels.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{label_col}`").alias("good")).dropna().groupBy("doc_id").agg((F.min("good") > 0).alias("good"))
    limits = labelled_thresholds(materialise(rated.filter("NOT base_failed").join(chosen, "doc_id").select("path", "cause", "good"), "rated"), len(_FEATURES))
    threshold = F.get(F.array(*[F.lit(float(x)) for x in limits]), F.col("cause"))
    return rated.withColumn("kept", ~F.col("base_failed") & (F.col("path") >= threshold)).drop("cause")
