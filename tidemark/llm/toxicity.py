"""Toxicity categories by a chain of linear classifiers.

Models follow each other in the order of CATEGORIES, the label itself last; each sees the hashed words and stems of a text and the
probabilities of the categories before it. In training these are out-of-fold: of each document from models that
have not seen it. The labels say only whether a text is toxic, so a category's label is that together with a
word of the category; a category without examples has probability 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import TRIMMED_SLICES, give_back, id_and_text, slices, trimmed
from .hashed_text import PLACES, Rows, WordPlaces, as_rows, labelled_rows, logistic, sigmoid

# Words that place a toxic text in a category, and the order of the chain.
CATEGORIES = {
    "insult": ["idiot", "moron", "stupid", "dumb", "fool", "clown", "loser", "imbecile"],
    "contempt": ["trash", "scum", "worthless", "garbage", "filth", "vermin"],
    "disgust": ["pathetic", "disgusting", "revolting", "gross", "vile"],
    "threat": ["kill", "hurt", "destroy", "beat", "die"],
}
LABEL = "toxic"
#: Labelled documents that are learned from.
TRAIN_ROWS = 8_000
FOLDS = 3
#: Words of too few or too many of them tell nothing.
LEAST_SHARE, MOST_SHARE = 0.001, 0.3


@dataclass
class Chain:
    """Per category: weight by place, and weights of earlier categories with the constant last. ``threshold`` is the label's."""

    names: list[str]
    places: np.ndarray
    weights: np.ndarray
    dense: list[np.ndarray]
    threshold: float

    def probabilities(self, places: np.ndarray) -> list[float]:
        if not len(self.names):
            return []
        at = np.minimum(np.searchsorted(self.places, places), max(len(self.places) - 1, 0))
        mine = at[self.places[at] == places] if len(self.places) else at[:0]
        sums, out = self.weights[:, mine].sum(axis=1), []
        for s, d in zip(sums, self.dense):
            out.append(0.0 if d is None else float(sigmoid(s + np.dot(d[:-1], out) + d[-1])))
        return out


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Midway in the gap of p that gives the best F1."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + y.sum())
    cuts = np.append(p[order][:-1] > p[order][1:], True)
    best = int(np.argmax(np.where(cuts, f1, -1)))
    after = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + after) / 2)


_PLACES_OF = {c: [xxhash.xxh3_64_intdigest(w.encode()) % PLACES for w in ws] for c, ws in CATEGORIES.items()}


def train_chain(places: list[np.ndarray], toxic: np.ndarray, ids: np.ndarray, folds: int = FOLDS, least: float = LEAST_SHARE) -> Chain:
    """``chain_of`` the documents with these ``places``."""
    has = np.array([[np.isin(w, p).any() for w in _PLACES_OF.values()] for p in places], bool).reshape(len(places), -1)
    return chain_of(as_rows(places, least, MOST_SHARE), has, toxic, ids, folds)


def chain_of(rows: Rows, has: np.ndarray, toxic: np.ndarray, ids: np.ndarray, folds: int = FOLDS) -> Chain:
    """Fit the chain; ``has`` tells of each document and category whether it has a word of it. Without both classes nothing is toxic (threshold above 1)."""
    names = [*CATEGORIES, LABEL]
    fold = np.array([xxhash.xxh3_64_intdigest(str(i)) % folds for i in ids], np.int64)
    earlier = np.zeros((rows.n, 0))
    weights, dense = np.zeros((len(names), len(rows.names))), []
    for c, name in enumerate(names):
        y = toxic if name == LABEL else toxic * has[:, c]
        if not y.any() or y.all():
            dense.append(None)
            earlier = np.column_stack([earlier, np.zeros(len(y))])
            continue
        w = logistic(rows, earlier, y)
        k = len(rows.names)
        weights[c] = w[:k]
        dense.append(w[k:])
        outside = np.zeros(len(y))
        for f in range(folds):
            mine = fold == f
            if mine.any() and not mine.all():
                v = logistic(rows.some(~mine), earlier[~mine], y[~mine])
                outside[mine] = sigmoid(rows.some(mine).times(v[:k]) + earlier[mine] @ v[k:-1] + v[-1])
        earlier = np.column_stack([earlier, outside])
    usable, used = dense[-1] is not None, weights.any(axis=0)
    return Chain(names, rows.names[used], weights[:, used], dense, _best_threshold(earlier[:, -1], toxic) if usable else 2.0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> Chain:
    table, rows = labelled_rows(docs, labels, [LABEL], train_rows, LEAST_SHARE, MOST_SHARE, id_col, text_col, groups=list(_PLACES_OF.values()), stems=True)
    has = table["group"].to_numpy()[:, None] >> np.arange(len(CATEGORIES)) & 1
    chain = chain_of(rows, has, (table[LABEL].to_numpy() > 0).astype(float), table["doc_id"].to_numpy())
    del rows, has
    give_back()
    return chain


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, p_<category> ..., p_toxic, rejected), one per row of ``docs``. A null or empty text has no words."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # at most a weight per category and word of the training rows
    names = [f"p_{c}" for c in chain.names]

    def apply(batches):
        chain, places = shared.value, WordPlaces(stems=True)
        for b in (part for whole in batches for part in slices(whole)):
            p = np.array([chain.probabilities(places(t)) for t in b["text"].to_pylist()]).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([b["doc_id"], *(pa.array(np.ascontiguousarray(p[:, i])) for i in range(len(names))), pa.array(p[:, -1] >= chain.threshold)], ["doc_id", *names, "rejected"])

    return id_and_text(docs, id_col, text_col).mapInArrow(lambda batches: trimmed(apply(batches), TRIMMED_SLICES), "doc_id bigint, " + ", ".join(f"{n} double" for n in names) + ", rejected boolean")


def toxic_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Fit on a bounded sample of labelled rows, score every row of ``docs``."""
    return score(docs, fit(docs, labels, id_col, text_col, train_rows), id_col, text_col)
