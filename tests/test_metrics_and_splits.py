from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics as mt
from tidemark.operators import splits as sp


def test_threshold_goldens(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.6), (1, 0.9)], "y int, p double")
    assert mt.choose_threshold(df, "y", "p", step=0.05).first().threshold == pytest.approx(0.45)
    tie = spark.createDataFrame([(0, 0.6), (1, 0.6)], "y int, p double")
    assert mt.choose_threshold(tie, "y", "p", step=0.2).first().threshold == pytest.approx(0.2)
    with pytest.raises(ValueError):
        mt.choose_threshold(df, "y", "p", metric="roc_auc")


@pytest.mark.parametrize("step", [0.01, 0.05, 0.2, 0.3])
def test_threshold_scan_matches_brute_force(spark, step):
    rows = [(i % 3 == 0, round(((i * 37) % 101) / 100, 2)) for i in range(300)]
    df = spark.createDataFrame([(int(y), p) for y, p in rows], "y int, p double")
    got = {r.threshold: r.f1 for r in mt.threshold_scan(df, "y", "p", step=step).collect()}
    assert sorted(got) == mt.threshold_grid(step)
    for t, f1 in got.items():
        tp = sum(y and p >= t for y, p in rows)
        fp, fn = sum(not y and p >= t for y, p in rows), sum(y and p < t for y, p in rows)
        assert f1 == pytest.approx(2 * tp / (2 * tp + fp + fn) if tp else 0.0)


def test_average_precision_is_not_trapezoidal(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, p double")
    assert mt.average_precision(df, "y", "p").first().pr_auc == pytest.approx(0.8333333)
    assert mt.roc_auc(df, "y", "p").first().roc_auc == 0.75


def test_empty_cells_and_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, pred int")
    cells = {(r.actual, r.predicted): r.n for r in mt.confusion_matrix(df, "y", "pred").collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    report = {r.label: r for r in mt.classification_report(df, "y", "pred").collect()}
    assert report["1"].precision == report["1"].recall == report["1"].f1_score == 0
    assert report["accuracy"].f1_score == pytest.approx(2 / 3)


def test_published_report_layout(spark):
    rows = [(0, 0, 648), (0, 1, 129), (1, 0, 93), (1, 1, 187)]
    df = spark.createDataFrame([(a, p) for a, p, n in rows for _ in range(n)], "y int, pred int")
    report = {r.label: r for r in mt.classification_report(df, "y", "pred").collect()}
    assert (report["0"].support, report["1"].support, report["weighted avg"].support) == (777, 280, 1057)
    assert report["1"].precision == pytest.approx(0.5918, abs=1e-4) and report["1"].recall == pytest.approx(0.6679, abs=1e-4)
    assert report["accuracy"].precision == pytest.approx(0.79, abs=1e-4)


def counts(df, *keys):
    return {tuple(r[k] for k in keys): r["count"] for r in df.groupBy(*keys).count().collect()}


def test_random_split_counts_and_determinism(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(10)], "id int, y int")
    spec = sp.SplitSpec(0.2, 0.2, seed=123)
    out = sp.assign(df, spec, "y", "id")
    assert counts(out, "split") == {("train",): 6, ("dev",): 2, ("test",): 2}
    assert counts(out, "split", "y")[("train", 1)] == 3
    again = sp.assign(df.repartition(5), spec, "y", "id")
    assert sorted(out.collect()) == sorted(again.collect())
    assert sorted(out.collect()) != sorted(sp.assign(df, sp.SplitSpec(0.2, 0.2, seed=1), "y", "id").collect())


def test_held_out_rows_are_the_test_rows(spark):
    df = spark.range(500).select("id", (F.col("id") % 5 == 0).cast("int").alias("y"))
    full = sp.assign(df, sp.SplitSpec.configured({}), "y", "id")
    test = sorted(r.id for r in full.filter("split = 'test'").collect())
    assert sorted(r.id for r in sp.test_rows(df, sp.SplitSpec(), "y", "id").collect()) == test
    two = sp.assign(df, sp.SplitSpec.configured({"train_size": 0.7, "dev_size": 0.15}, parts=2), "y", "id")
    assert sorted(r.id for r in two.filter("split = 'test'").collect()) == test


def test_many_classes(spark, monkeypatch):
    """Counts per class are exact with thousands of classes, nulls among them, whether cut-offs are broadcast or joined."""
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 5_000).alias("y"))
    spec = sp.SplitSpec(0.25, None)
    out = sp.assign(df, spec, "y", "id")
    assert counts(out, "split") == {("train",): 22_500, ("test",): 7_500}
    assert counts(out.filter("y IS NULL"), "split") == {("train",): 7_500, ("test",): 2_500}
    each = out.filter("split = 'test'").groupBy("y").count().filter("y IS NOT NULL").agg(F.min("count"), F.max("count")).first()
    assert each[0] >= 1 and each[1] <= 2
    monkeypatch.setattr(sp, "BROADCAST_CLASSES", 10)
    assert sorted(sp.assign(df, spec, "y", "id").collect()) == sorted(out.collect())


def test_time_split(spark):
    rows = [("2024-01-01", 1), ("2024-02-01", 2), ("2024-03-01", 3), ("2024-04-01", 4), (None, 5)]
    df = spark.createDataFrame(rows, "day string, f int")
    spec = sp.SplitSpec(date_col="day", test_after="2024-03-15", dev_after="2024-02-15")
    out = {r.f: r.split for r in sp.assign(df, spec, "f", "f").collect()}
    assert out == {1: "train", 2: "train", 3: "dev", 4: "test"}
    assert [r.f for r in sp.test_rows(df, spec, "f", "f").collect()] == [4]
    with pytest.raises(sp.EmptySplitError):
        sp.assign(df, replace(spec, test_after="2030-01-01"), "f", "f")
    with pytest.raises(ValueError):
        sp.assign(df, replace(spec, date_col="absent"), "f", "f")


def test_fallbacks_and_bad_sizes(spark):
    df = spark.createDataFrame([(i, i % 2, "2024-01-01") for i in range(40)], "id int, y int, day string")
    cfg = {"strategy": "time", "dev_end": "2025-01-01", "date_col": "day"}
    with pytest.warns(UserWarning):
        assert set(counts(sp.assign(df, sp.SplitSpec.configured(cfg, parts=2), "y", "id"), "split")) == {("train",), ("test",)}
    with pytest.raises(ValueError):
        sp.assign(df, sp.SplitSpec.configured({**cfg, "fallback": "none"}, parts=2), "y", "id")
    for bad in ({"train_size": 0.9, "dev_size": 0.2}, {"strategy": "other"}, {"strategy": "time"}, {"dev_size": 0.0}):
        with pytest.raises(ValueError):
            sp.SplitSpec.configured(bad)
    assert sp.SplitSpec.configured({"strategy": "time", "fallback": "random"}) == sp.SplitSpec()


def test_saved_ids(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 2, 1), ("c", 3, 0)], "customerID string, f int, y int")
    saved = sp.SavedSplit(spark.createDataFrame([("a", "test"), ("c", "TEST"), ("b", "train")], "row_id string, split string"))
    got = saved.select(df, ["f"], "customerID", "y", "y")
    assert sorted((r.customerID, r.f) for r in got.collect()) == [("a", 1), ("c", 3)]
    with pytest.raises(ValueError):
        sp.SavedSplit(spark.createDataFrame([("x",)], "row_id string")).select(df, ["f"], "customerID", "y", "y")
    whole = sp.SavedSplit(spark.createDataFrame([(9, 1)], "f int, target int"))
    assert [tuple(r) for r in whole.select(df, ["f"], "customerID", "label", "y").collect()] == [(9, 1)]


def test_feature_contract():
    sp.validate_features(["a", "b"], ["b", "a"])
    with pytest.raises(ValueError):
        sp.validate_features(["a", "b"], ["a", "c"])
    assert sp.find_id_column(["x", "user_id", "id"], "subscription") == "user_id"
    assert sp.find_id_column(["x", "user_id", "id"], "telco") == "id"
