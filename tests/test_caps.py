import pytest
from pyspark.sql import functions as F

from tidemark.catalog import learning
from tidemark.fixed_values import CAPPED_COLUMNS
from tidemark.operators.caps import Caps, capped_pairs
from tidemark.operators.quantiles import add_capped_columns
from tidemark.plans import score as sc
from tidemark.plans import train as tr
from tidemark.session import materialise

CAPPED = [f"{c}_capped" for c in CAPPED_COLUMNS]
CONFIG = {**learning._CAPS_CONFIG, "models": {"logistic_regression": {"max_iter": 10}}, "candidates": ["logistic_regression"]}


@pytest.fixture(scope="module")
def table(spark):
    return materialise(learning._capped_features(spark, "/root/testdata/sf0.01"), "features")


@pytest.fixture(scope="module")
def data(table):
    return tr.assemble_dataset(table, CONFIG, "here")


def test_bounds_come_from_the_given_rows(spark):
    rows = spark.createDataFrame([(float(i), None) for i in range(101)], "total_secs_sum double, num_unq_sum double")
    caps = Caps.fitted(rows)
    assert caps.bounds == {"total_secs_sum": (1.0, 99.0), "num_unq_sum": (None, None)}
    other = spark.createDataFrame([(-5.0, 7.0), (500.0, None), (50.0, 1.0), (None, 2.0)], "total_secs_sum double, num_unq_sum double")
    got = caps.applied(other).select("total_secs_sum_capped", "num_unq_sum_capped").collect()
    assert [tuple(r) for r in got] == [(1.0, 7.0), (99.0, None), (50.0, 1.0), (None, 2.0)]
    assert Caps.of_rows([r.asDict() for r in caps.table(spark).collect()]) == caps and Caps.of_rows(None) is None


def test_stored_test_rows_keep_their_caps(spark):
    caps = Caps({"total_secs_sum": (0.0, 1.0)})
    assert caps.applied(spark.createDataFrame([(9.0,)], "total_secs_sum_capped double")).first().total_secs_sum_capped == 9.0


def test_test_rows_change_no_training_feature(table, data):
    late = F.col("latest_transaction_date") > "2001-06-01"
    wild = table.withColumns({c: F.when(late, F.col(c).cast("double") * 1000 + 10**6).otherwise(F.col(c)) for c in capped_pairs(table)})
    changed = tr.assemble_dataset(add_capped_columns(materialise(wild.drop(*CAPPED), "wild")), CONFIG, "here")
    rows = lambda d: sorted(tuple(r) for r in d.frame.filter("split = 'train'").select("msno", *CAPPED).collect())
    assert len(rows(data)) > 50 and repr(rows(data)) == repr(rows(changed)) and changed.caps == data.caps
    assert tr.assemble_dataset(table, {**CONFIG, "data": {**CONFIG["data"], "fit_on": "all"}}, "here").caps != data.caps


def test_scored_rows_have_the_training_caps(spark, table, data, tmp_path):
    tr.train_champion(spark, data, CONFIG, str(tmp_path))
    model, meta = tr.load_run(spark, str(tmp_path))
    assert Caps.of_rows(meta["caps"]) == data.caps
    one = table.filter("latest_transaction_date IS NOT NULL").limit(1).withColumn("total_amount_paid", F.lit(1e12))
    features = sc.features_for(one, meta["numeric_cols"], meta["categorical_cols"], "subscription", caps=Caps.of_rows(meta["caps"]))
    assert features.first().total_amount_paid_capped == data.caps.bounds["total_amount_paid"][1]
    low = one.withColumn("total_amount_paid", F.lit(data.caps.bounds["total_amount_paid"][1]))
    scores = [sc.score_batch(x, model, meta).first().churn_probability for x in (one, low)]
    assert scores[0] == scores[1]


def test_evaluation_applies_the_caps(spark, table, tmp_path):
    path = f"{tmp_path}/features.parquet"
    table.write.parquet(path)
    cfg = {**CONFIG, "data": {"dataset_type": "subscription", "feature_path": path}}
    loaded = tr.load_dataset(spark, cfg)
    tr.train_champion(spark, loaded, cfg, str(tmp_path))
    snapshot = sc.evaluate_run(spark, cfg, str(tmp_path), f"{tmp_path}/reports").first()
    assert snapshot.customers_scored == loaded.frame.filter("split = 'test'").count()
