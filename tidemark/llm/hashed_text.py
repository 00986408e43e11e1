"""Hashed words of texts as sparse rows, and linear models on them in numpy."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .common import id_and_text, trimmed

#: Places a word can hash to.
PLACES = 1 << 20
_SPACED = bytes(b if b >= 128 or chr(b).isalnum() or b in b"_" else 32 for b in range(256)).lower()
_RUNS = re.compile(rb"[!-/:-@\[-`{-~]{2,}|[#*$%&|<>]")


class WordPlaces:
    """Places of the distinct words of a text; ``stems`` adds their first 3 to 6 letters, ``marks`` runs of
    punctuation and steps of repetition, ``pairs`` neighbouring words.

    Words are split at white space and ASCII punctuation, A-Z lower-cased. One per task; remembers words.
    """

    def __init__(self, marks: bool = False, pairs: bool = False, stems: bool = False):
        self._known: dict[bytes, int] = {}
        self._stems: dict[bytes, list[int]] = {}
        self._marks, self._pairs, self._stemmed = marks, pairs, stems

    @staticmethod
    def _stem_places(word: bytes) -> list[int]:
        letters = word.decode(errors="replace")
        return [xxhash.xxh3_64_intdigest(f"{letters[:k]}*".encode()) % PLACES for k in (3, 4, 5, 6) if len(letters) > k]

    def __call__(self, text: str) -> np.ndarray:
        data = text.encode()
        words = data.translate(_SPACED).split()
        if len(self._known) > 1_000_000:
            self._known.clear()
        known = self._known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w) % PLACES
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        found = [np.unique(ids)]
        if self._stemmed:
            if len(self._stems) > 300_000:
                self._stems.clear()
            distinct, stems = set(words), self._stems
            for w in distinct.difference(stems):
                stems[w] = self._stem_places(w)
            found.append(np.array([p for w in distinct for p in stems[w]], np.int64))
        if self._pairs and len(ids) > 1:
            found.append(np.unique((ids[:-1] * 1_000_003 + ids[1:] * 7919 + 17) % PLACES))
        if self._marks and len(words):
            runs = _RUNS.findall(data)
            extra = [b"run %s" % r[:4] for r in set(runs)]
            extra += [b"runs %d" % k for k in range(1, 12) if len(runs) * 2 ** k >= len(words)]
            extra += [b"repeats %d" % k for k in range(1, 10) if 10 * len(found[0]) <= k * len(words)]
            extra += [b"fewer %d" % k for k in (5, 10, 20, 50) if len(words) < k]
            found.append(np.array([xxhash.xxh3_64_intdigest(x) % PLACES for x in extra], np.int64))
        return np.unique(np.concatenate(found))


@dataclass
class Rows:
    """Sparse 0/1 rows: the places of row i are ``place[start[i]:start[i + 1]]``, numbered within ``names``."""

    start: np.ndarray
    place: np.ndarray
    names: np.ndarray  # hashed place of each column, ascending

    @property
    def n(self) -> int:
        return len(self.start) - 1

    @cached_property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.n, dtype=np.int32), np.diff(self.start))

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.place], minlength=self.n)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.place, values[self.row], minlength=len(self.names))

    def only(self, columns: np.ndarray) -> Rows:
        """The same rows with ``columns`` alone."""
        number = np.full(len(self.names), -1, np.int32)
        number[columns] = np.arange(len(columns))
        keep = number[self.place] >= 0
        return Rows(np.append(0, np.cumsum(np.bincount(self.row[keep], minlength=self.n))), number[self.place[keep]], self.names[columns])

    def some(self, chosen: np.ndarray) -> Rows:
        """The rows where ``chosen``."""
        size = np.diff(self.start)
        return Rows(np.append(0, np.cumsum(size[chosen])), self.place[np.repeat(chosen, size)], self.names)


def as_rows(lists: list[np.ndarray], least: float, most: float) -> Rows:
    """Rows of hashed places, only of those in a share of ``least`` to ``most`` of the rows, and in 4 at least."""
    flat = np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)
    names, column, seen = np.unique(flat, return_inverse=True, return_counts=True)
    keep = (seen >= max(4, least * len(lists))) & (seen <= most * len(lists))
    number = np.cumsum(keep) - 1
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    chosen = keep[column]
    return Rows(np.append(0, np.cumsum(np.bincount(row[chosen], minlength=len(lists)))), number[column[chosen]], names[keep])


def labelled_rows(docs: DataFrame, labels: DataFrame, columns: list[str], rows: int, least: float, most: float, id_col: str, text_col: str,
                  groups: list[list[int]] = (), **options) -> tuple[pa.Table, Rows]:
    """(table (doc_id, ``columns``, group), the same documents' Rows) of at most ``rows`` labelled documents, those of the smallest hashes of the id.

    ``rows`` bounds what comes to the driver, in rows of the places that a share of ``least`` to ``most`` of the documents have, and 4 at least;
    these are counted, and the others dropped, before. Bit i of ``group`` says whether the text has one of the places ``groups[i]``. Rows with a null id or label are no
    labels; an id with several labels has the smallest; a text that repeats under one id counts once, and an id with several texts takes part with each of them, within ``rows``.
    """
    spark = docs.sparkSession
    chosen = labels.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), *[F.col(f"`{c}`").cast("int").alias(c) for c in columns]).dropna()
    chosen = chosen.groupBy("doc_id").agg(*[F.min(c).alias(c) for c in columns]).orderBy(F.xxhash64("doc_id")).limit(rows)
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # at most `rows` rows
    names, marks = ["doc_id", *columns], [np.array(sorted(g), np.int64) for g in groups]

    def place(batches):
        places = WordPlaces(**options)
        for b in batches:
            found = [places(t) for t in b["text"].to_pylist()]
            group = [sum(int(np.isin(g, p).any()) << i for i, g in enumerate(marks)) for p in found]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in [*names, "hash"]), pa.array(group, pa.int32()), pa.array([p.astype(np.int32) for p in found], pa.list_(pa.int32()))],
                                             [*names, "hash", "group", "places"])

    schema = ", ".join([f"{c} {'bigint' if c == 'doc_id' else 'int'}" for c in names])
    placed = texts.select(*names, F.xxhash64("text").alias("hash"), "text").mapInArrow(lambda b: trimmed(place(b)), f"{schema}, hash bigint, group int, places array<int>")
    stored = materialise(placed.dropDuplicates(["doc_id", "hash"]).orderBy(F.xxhash64("doc_id"), "hash").limit(rows), "labelled")

    n = stored.count()
    seen = stored.select(F.explode("places").alias("place")).groupBy("place").agg(F.count("*").alias("n"))
    kept = seen.filter((F.col("n") >= max(4, least * n)) & (F.col("n") <= most * n)).select("place").toArrow()  # of PLACES at most
    vocabulary = spark.sparkContext.broadcast(np.sort(kept["place"].to_numpy()))

    def number(batches):
        names = vocabulary.value
        for b in batches:
            flat, ends = b["places"].flatten().to_numpy(), b["places"].offsets.to_numpy() - b["places"].offsets[0].as_py()
            at = np.searchsorted(names, flat)
            hit = names[np.minimum(at, len(names) - 1)] == flat if len(names) else np.zeros(len(flat), bool)
            cut = np.append(0, np.cumsum(hit))[ends].astype(np.int32)
            yield b.drop_columns(["places"]).append_column("columns", pa.ListArray.from_arrays(pa.array(cut), pa.array(at[hit].astype(np.int32))))

    table = stored.select(*names, "group", "hash", "places").mapInArrow(number, f"{schema}, group int, hash bigint, columns array<int>").toArrow()
    table = table.sort_by([("doc_id", "ascending"), ("hash", "ascending")])
    lists = table["columns"].combine_chunks()
    sparse = Rows(lists.offsets.to_numpy(), lists.values.to_numpy(), vocabulary.value) if len(lists) else Rows(np.zeros(1, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32))
    return table.select([*names, "group"]), sparse


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def descend(gradient, size: int, steps: int = 120, rate: float = 0.1) -> np.ndarray:
    """Minimise by Adam over full gradients; ``gradient(x)`` is that at x."""
    x, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(x)
        mean += 0.1 * (g - mean)
        square += 0.001 * (g * g - square)
        x -= rate * (1 - 0.9 * (t - 1) / steps) * mean / (1 - 0.9 ** t) / (np.sqrt(square / (1 - 0.999 ** t)) + 1e-8)
    return x


#: Places count whose shares among the two classes differ by so many standard errors.
SIGNIFICANT = 5.0


def telling(rows: Rows, y: np.ndarray) -> np.ndarray:
    """Columns whose shares differ significantly between the classes."""
    ones, total = np.bincount(rows.place, y[rows.row], len(rows.names)), np.bincount(rows.place, minlength=len(rows.names))
    n1, n0, share = max(y.sum(), 1), max(len(y) - y.sum(), 1), total / max(len(y), 1)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
    return np.flatnonzero(np.abs(ones / n1 - (total - ones) / n0) > SIGNIFICANT * error)


def logistic(rows: Rows, dense: np.ndarray, y: np.ndarray, l2: float = 1e-4) -> np.ndarray:
    """Weights of the columns, of ``dense`` and of a constant, both classes weighing alike; 0 for columns that tell nothing."""
    chosen, d = telling(rows, y), dense.shape[1]
    used, k = rows.only(chosen), len(chosen)
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max(len(y) - y.sum(), 1))

    def gradient(w: np.ndarray) -> np.ndarray:
        r = (sigmoid(used.times(w[:k]) + dense @ w[k:k + d] + w[-1]) - y) * share
        return np.concatenate([used.back(r) + l2 * w[:k], dense.T @ r + l2 * w[k:k + d], [r.sum()]])

    w = descend(gradient, k + d + 1)
    out = np.zeros(len(rows.names) + d + 1)
    out[chosen], out[len(rows.names):] = w[:k], w[k:]
    return out
