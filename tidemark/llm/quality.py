"""Graded quality by ordinal cumulative-link regression on hashed text.

One weight per hashed word and ordered thresholds t1 < t2 < ...: P(grade <= k) = sigmoid(t_k - score). The likelihood of
the grades is maximised over both, thresholds as a first one and logarithms of the steps. Grades give each text an
expected grade, and the probability of a grade of at least ``select_grade`` selects it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import id_and_text
from .hashed_text import Rows, WordPlaces, descend, labelled_rows, sigmoid

#: Labelled documents that are learned from.
TRAIN_ROWS = 8_000
LEAST_SHARE, MOST_SHARE = 0.004, 0.3
#: Texts are selected whose probability of ``select_grade`` or better is at least this.
SELECT_PROBABILITY = 0.5


@dataclass
class Grades:
    places: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, places: np.ndarray) -> float:
        if not len(self.places):
            return 0.0
        at = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return float(self.weights[at[self.places[at] == places]].sum())

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... in columns."""
        return sigmoid(scores[:, None] - self.thresholds[None, :])


def fit_grades(rows: Rows, grade: np.ndarray, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of greatest likelihood; grades are 0 to K, every grade weighing alike."""
    top, k = int(grade.max(initial=0)), len(rows.names)
    if not top:
        return np.zeros(k), np.full(1, -20.0)  # one grade only: everything is as good as that
    count = np.bincount(grade, minlength=top + 1)
    share = (1 / np.maximum(count, 1) / (count > 0).sum())[grade]

    def thresholds(x: np.ndarray) -> np.ndarray:
        return x[k] + np.append(0, np.cumsum(np.exp(x[k + 1:])))

    def gradient(x: np.ndarray) -> np.ndarray:
        score, t = rows.times(x[:k]), np.concatenate([[-np.inf], thresholds(x), [np.inf]])
        upper, lower = sigmoid(t[grade + 1] - score), sigmoid(t[grade] - score)
        inside = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / inside * share, lower * (1 - lower) / inside * share
        of_t = np.bincount(grade, -du, top + 1)[:top] + np.bincount(np.maximum(grade - 1, 0), np.where(grade > 0, dl, 0), top + 1)[:top]
        later = np.cumsum(of_t[::-1])[::-1]  # a step moves all thresholds after it
        return np.concatenate([rows.back(du - dl) + l2 * x[:k], [later[0]], later[1:] * np.exp(x[k + 1:])])

    x = descend(gradient, k + top)
    return x[:k], thresholds(x)


def fit(docs: DataFrame, graded: DataFrame, grade_col: str = "grade", id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> Grades:
    """Fit on at most ``train_rows`` rows of ``graded``, whose ``grade_col`` counts up from 0."""
    table, rows = labelled_rows(docs, graded, [grade_col], train_rows, LEAST_SHARE, MOST_SHARE, id_col, text_col, marks=True)
    return Grades(rows.names, *fit_grades(rows, table[grade_col].to_numpy().astype(np.int64)))


def score(docs: DataFrame, grades: Grades, select_grade: int = 1, least: float = SELECT_PROBABILITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, expected_grade, tail_probability, selected), one per row of ``docs``. A null or empty text has no words."""
    shared = docs.sparkSession.sparkContext.broadcast(grades)  # at most a weight per word of the training rows
    at = min(max(select_grade, 1), len(grades.thresholds)) - 1

    def apply(batches):
        grades, places = shared.value, WordPlaces(marks=True)
        for b in batches:
            tails = grades.tails(np.array([grades.score(places(t)) for t in b["text"].to_pylist()], float))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(tails.sum(axis=1)), pa.array(np.ascontiguousarray(tails[:, at])), pa.array(tails[:, at] >= least)],
                                             ["doc_id", "expected_grade", "tail_probability", "selected"])

    return id_and_text(docs, id_col, text_col).mapInArrow(apply, "doc_id bigint, expected_grade double, tail_probability double, selected boolean")


def grades_of(labels: DataFrame) -> DataFrame:
    """Grades from the two labels: 0 poor, 1 sound but toxic, 2 sound and clean. A null label counts as not toxic."""
    return labels.select("doc_id", F.when(F.col("quality") > 0, F.when(F.col("toxic") > 0, 1).otherwise(2)).when(F.col("quality").isNotNull(), 0).alias("grade"))
