from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.catalog.bindings import bind
from tidemark.catalog import learning
from tidemark.catalog.learning import CONFIG
from tidemark.operators import explain as ex
from tidemark.operators import models as m
from tidemark.operators.metrics import roc_auc
from tidemark.plans import score as sc
from tidemark.plans import train as tr
from tidemark.streaming.scoring import read_requests, start_scoring

SMALL = {**CONFIG, "models": {"logistic_regression": {"max_iter": 15}, "boosted_shallow": {"n_estimators": 4, "learning_rate": 0.3}}}


@pytest.fixture(scope="module")
def telco(spark):
    return bind(spark, "/root/testdata/sf0.001", "b_telco").persist()


@pytest.fixture(scope="module")
def data(telco):
    return tr.assemble_dataset(telco, SMALL, "here")


@pytest.fixture(scope="module")
def ready(data):
    rows = m.prepared(data.frame, data)
    fitted = m.fit_preprocessor(rows, data.numeric, data.categorical)
    return fitted, fitted.transform(rows).select("customerID", "split", m.LABEL, m.WEIGHT, "features").persist()


def test_dataset_roles(data):
    assert len(data.numeric) + len(data.categorical) == 40
    assert {"tenure", "MonthlyCharges", "num_services"} <= set(data.numeric)
    assert {"tenure_group", "Contract"} <= set(data.categorical)
    assert not {"Churn", "ChurnFlag", "customerID", "split"} & set(data.features)


def test_unknown_category_is_all_zero(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    fitted = m.fit_preprocessor(df, [], ["c"])
    assert m.feature_names(fitted) == ["cat__c_a", "cat__c_b"]
    got = fitted.transform(spark.createDataFrame([("a",), ("zzz",)], "c string")).select(vector_to_array("features")).collect()
    assert [r[0] for r in got] == [[1.0, 0.0], [0.0, 0.0]]


def test_attributions_add_up_to_the_margin(ready):
    fitted, rows = ready
    model = m.boosted_trees({"n_estimators": 4, "max_depth": 4, "learning_rate": 0.4}).fit(rows)
    attributed, expected = ex.tree_attributions(m.scored(model, rows), model)
    for r in attributed.select("attributions", m.SCORE).collect():
        assert sum(r.attributions) + expected == pytest.approx(np.log(r[m.SCORE] / (1 - r[m.SCORE])), abs=1e-9)
    top = ex.driver_columns(attributed, m.feature_names(fitted)).first()
    assert top.top_driver_1.endswith("risk)") and top.primary_driver_theme
    table = ex.mean_absolute(attributed, m.feature_names(fitted), top_n=5).collect()
    assert [r.mean_abs_shap for r in table] == sorted((r.mean_abs_shap for r in table), reverse=True)


def test_attributions_are_shapley_values():
    """Against the definition: the average over feature orders of the tree's conditional value."""
    leaves = [
        (1.0, {0: (-np.inf, 0.5, 0.4), 1: (-np.inf, 0.0, 0.25)}), (-2.0, {0: (-np.inf, 0.5, 0.4), 1: (0.0, np.inf, 0.75)}),
        (3.0, {0: (0.5, np.inf, 0.6), 2: (-np.inf, 1.0, 0.5)}), (5.0, {0: (0.5, np.inf, 0.6), 2: (1.0, np.inf, 0.5)}),
    ]

    def value(x, known):
        return sum(v * np.prod([float(lo < x[f] <= hi) if f in known else share for f, (lo, hi, share) in c.items()]) for v, c in leaves)

    x = np.array([[0.2, -1.0, 2.0], [0.9, 1.0, 0.0]])
    got = ex._attributions(x, leaves)
    for i in range(2):
        for f in range(3):
            rest = [g for g in range(3) if g != f]
            phi = sum(
                factorial(k) * factorial(2 - k) / 6 * (value(x[i], {*s, f}) - value(x[i], set(s)))
                for k in range(3) for s in combinations(rest, k)
            )
            assert got[i, f] == pytest.approx(phi)


def test_champion_round_trip(spark, telco, data, tmp_path):
    directory = str(tmp_path)
    result = tr.train_champion(spark, data, {**SMALL, "candidates": ["logistic_regression", "boosted_shallow"]}, directory)
    assert {r.model_name for r in result["candidates"].collect()} == {"logistic_regression", "boosted_shallow"}
    model, meta = tr.load_run(spark, directory)
    assert meta["champion_model"] == result["champion"] and meta["threshold"] == result["threshold"]
    assert set(meta["feature_columns"]) == set(data.features)

    scored = sc.score_batch(telco, model, meta).persist()
    assert scored.count() == telco.count()
    assert set(telco.columns) <= set(scored.columns)
    assert scored.filter("churn_probability < 0 or churn_probability > 1 or expected_revenue_at_risk < 0").count() == 0
    again = sc.score_batch(telco.repartition(7), model, meta, explain=False)
    both = scored.select("customerID", "churn_probability").join(again.select("customerID", F.col("churn_probability").alias("p")), "customerID")
    assert both.filter("abs(churn_probability - p) > 1e-12").count() == 0

    telco.write.parquet(f"{directory}/telco.parquet")
    cfg = {**SMALL, "data": {"dataset_type": "telco", "raw_path": "here"}}
    with pytest.raises(ValueError):
        sc.check_contract(meta, "subscription")
    cfg["data"]["raw_path"] = f"{directory}/telco.parquet"
    with pytest.raises(ValueError):  # trained on another source
        sc.evaluate_run(spark, cfg, directory, f"{directory}/reports")


def test_evaluation_uses_the_saved_split(spark, telco, tmp_path):
    directory = str(tmp_path)
    path = f"{directory}/telco.parquet"
    telco.write.parquet(path)
    cfg = {**SMALL, "data": {"dataset_type": "telco", "raw_path": path}, "candidates": ["logistic_regression"]}
    loaded = tr.load_dataset(spark, cfg)
    tr.train_champion(spark, loaded, cfg, directory)
    snapshot = sc.evaluate_run(spark, cfg, directory, f"{directory}/reports").first()
    assert snapshot.customers_scored == loaded.frame.filter("split = 'test'").count()
    assert snapshot.monthly_revenue_at_risk > 0
    assert spark.read.option("header", True).csv(f"{directory}/reports/test_set_scored.csv").count() == snapshot.customers_scored


def test_linear_models_name_no_drivers(spark, telco, data):
    rows = m.prepared(data.frame, data)
    fitted = m.fit_preprocessor(rows, data.numeric, data.categorical)
    model = PipelineModel([*fitted.stages, m.logistic(100, 10).fit(fitted.transform(rows))])
    out = sc.score_rows(telco, model, data.numeric, data.categorical, cutoffs=(data.extra["p75"], data.extra["median"]))
    assert not [c for c in out.columns if c.startswith("top_driver")]
    importance = m.global_importance(model.stages[-1], m.feature_names(model), 5)
    assert len(importance) == 5 and importance[0][1] >= importance[-1][1] >= 0


def test_search_is_repeatable_and_merged(spark, data, tmp_path):
    space = {"n_estimators": ("int", 2, 3), "max_depth": ("int", 2, 3)}
    cfg = {**SMALL, "tuning": {"algorithm": "boosted_shallow", "n_trials": 2}}
    best = tr.tune(spark, data, cfg, str(tmp_path), space)
    assert best == tr.tune(spark, data, cfg, str(tmp_path / "again"), space)
    merged = tr.apply_tuned_params(spark, cfg, str(tmp_path))
    assert merged["models"]["boosted_shallow"]["max_depth"] == best["params"]["max_depth"]
    assert "max_depth" not in cfg["models"]["boosted_shallow"]
    with pytest.raises(ValueError):
        m.random_search(None, "unknown")


def test_uplift_scores_find_the_responders(spark):
    df = spark.range(2000).select(
        "id", (F.col("id") % 2).cast("int").alias("treatment"), (F.pmod(F.xxhash64("id"), F.lit(2))).cast("double").alias("x"), F.rand(3).alias("noise")
    ).withColumn("outcome", F.when((F.col("x") == 1) & (F.col("treatment") == 1), F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(10)) < 8).otherwise(F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(10)) < 3).cast("int")).persist()
    scored, _, _ = m.two_model_uplift(df, ["x", "noise"])
    means = {r.x: r.u for r in scored.groupBy("x").agg(F.avg("uplift_score").alias("u")).collect()}
    assert scored.columns == df.columns + ["uplift_score"]
    assert means[1.0] > 0.3 and abs(means[0.0]) < 0.1


def test_isotonic_is_monotone(ready):
    _, rows = ready
    folds = m.fit_isotonic_folds(rows, m.logistic(100, 10), "customerID")
    out = m.calibrated(rows, folds)
    assert out.filter("calibrated_probability < 0 or calibrated_probability > 1").count() == 0
    assert roc_auc(out.withColumn("y", F.col(m.LABEL).cast("int")), "y", "calibrated_probability").first().roc_auc > 0.5


def test_stream_gives_the_batch_result(spark, telco, data, tmp_path):
    directory = str(tmp_path)
    tr.train_champion(spark, data, {**SMALL, "candidates": ["logistic_regression"]}, directory)
    model, meta = tr.load_run(spark, directory)
    telco.repartition(3).write.parquet(f"{directory}/requests")
    stream = read_requests(spark, f"{directory}/requests", telco.schema, files_per_trigger=1)
    start_scoring(stream, model, meta, f"{directory}/responses", f"{directory}/state").awaitTermination()
    got = {r.customer_id: r for r in spark.read.parquet(f"{directory}/responses").collect()}
    batch = sc.score_batch(telco, model, meta, explain=False).collect()
    assert set(got) == {r.customerID for r in batch}
    for r in batch:
        assert got[r.customerID].churn_probability == pytest.approx(r.churn_probability)
        assert got[r.customerID].predicted_churn == r.predicted_churn


def test_logistic_beats_chance(data):
    split = m.prepare_split(data)
    try:
        row = m.dev_metrics(m.logistic(split.n_train, 15).fit(split.train), split.train, "x")
    finally:
        split.release()
    assert row["roc_auc"] > 0.5 and 0 <= row["f1"] <= 1 and row["f1"] == pytest.approx(row["dev_best_f1_scan"])


@pytest.mark.parametrize("name", ["m5_logistic", "n11_isotonic"])
def test_logistic_queries_train_with_the_declared_iterations(spark, sf, monkeypatch, name):
    seen, logistic = [], m.logistic
    monkeypatch.setattr(m, "logistic", lambda *a, **k: seen.append(logistic(*a, **k)) or seen[-1])
    assert getattr(learning, name)(spark, sf).count() > 0
    assert [x.getMaxIter() for x in seen] == [2000]
