import threading

import pytest
from pyspark.sql import functions as F

from tidemark.operators import models as m
from tidemark.plans import train as tr


@pytest.fixture(scope="module")
def data(spark):
    rows = [(str(i), float(i % 7), "ab"[i % 2], int(i % 3 == 0), ("train", "train", "train", "dev", "test")[i % 5]) for i in range(120)]
    frame = spark.createDataFrame(rows, "id string, x double, c string, y int, split string").coalesce(1)
    return m.Dataset(frame, ["x"], ["c"], "y", "id")


def test_candidates_are_fitted_side_by_side(spark, data, monkeypatch):
    meeting, fits = threading.Barrier(2, timeout=60), []

    class Meeting:
        def __init__(self, estimator):
            self.estimator = estimator

        def fit(self, rows):
            fits.append(1)
            if len(fits) <= 2:  # the third is the champion's refit
                meeting.wait()
            return self.estimator.fit(rows)

    monkeypatch.setattr(m, "candidate_models", lambda models, n, seed=42: {k: Meeting(m.logistic(n, 5)) for k in ("one", "two")})
    result = tr.train_champion(spark, data, {"data": {}, "split": {}})
    assert result["champion"] == "one" and len(fits) == 3
    assert [r.model_name for r in result["candidates"].collect()] == ["one", "two"]


def test_what_still_runs_is_cancelled(spark):
    ended, rounds = threading.Event(), []

    def endless():
        try:
            while True:
                rounds.append(spark.range(10).count())
        finally:
            ended.set()

    with pytest.raises(KeyError):
        with m.side_by_side(spark, {"endless": endless, "short": lambda: spark.range(3).count()}) as running:
            assert running["short"].get() == 3
            raise KeyError("stop")
    assert ended.is_set()
    assert spark.range(5).count() == 5


def test_stored_vectors_are_dealt_out_by_rows(spark, data, monkeypatch):
    """One stored file of many rows is not one task's."""
    monkeypatch.setattr(m, "ROWS_PER_TASK", 10)
    rows = m.prepared(data.frame, data)
    ready = m.fit_preprocessor(rows, data.numeric, data.categorical).transform(rows)
    parts = m.stored_vectors(ready, data, 120)
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 12 and sum(sizes) == 120 and max(sizes) <= 20
    monkeypatch.setattr(m, "ROWS_PER_TASK", 120)
    assert m.stored_vectors(ready, data, 120).rdd.getNumPartitions() == 1
