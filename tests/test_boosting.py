"""Trees grown in one job are MLlib's own trees."""

import uuid

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tidemark.operators import boosting as b
from tidemark.operators import models as m


@pytest.fixture(scope="module")
def rows(spark):
    """12,000 rows, so split candidates come from a sample; numbers with many and few values, flags, a flag and its opposite."""
    def draw(k):
        return F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10_000)) / 10_000

    numbers = spark.range(12_000, numPartitions=1).select("id", draw(1).alias("a"), F.floor(draw(2) * 9).cast("double").alias("b"), (draw(3) - 0.5).alias("c"),
                                                          (draw(4) < 0.3).cast("int").alias("flag"), (draw(4) >= 0.3).cast("int").alias("other"), F.lit(1.0).alias("same"))
    risk = F.col("a") * 0.5 + F.col("b") / 30 + F.when((F.col("c") > 0.1) & (F.col("flag") == 1), 0.4).otherwise(0.0)
    named = numbers.withColumn(m.LABEL, (draw(5) < risk).cast("double")).withColumn(m.WEIGHT, F.when(F.col(m.LABEL) == 1, 1.7).otherwise(1.0))
    ready = VectorAssembler(inputCols=["a", "b", "c", "same", "flag", "other"], outputCol="features").transform(named)
    attributes = {"numeric": [{"idx": i, "name": n} for i, n in enumerate(("a", "b", "c", "same"))], "binary": [{"idx": 4, "name": "flag"}, {"idx": 5, "name": "other"}]}
    ready = ready.withColumn("features", F.col("features").alias("features", metadata={"ml_attr": {"attrs": attributes, "num_attrs": 6}}))
    return ready.select("id", m.LABEL, m.WEIGHT, "features").persist()


def stored(spark, model, tmp_path) -> list:
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    model.write().save(path)
    return spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()


def mllib(estimator, rows):
    plain = GBTClassifier()
    plain = plain.copy({plain.getParam(p.name): v for p, v in estimator.extractParamMap().items() if p.name not in ("lossType", "impurity")})
    return plain.fit(rows)


def equal_trees(spark, a, c, tmp_path) -> bool:
    def shape(r):
        return r.treeID, r.id, r.leftChild, r.rightChild, r.rawCount, r.split.featureIndex, tuple(r.split.leftCategoriesOrThreshold), r.split.numCategories

    x, y = stored(spark, a, tmp_path), stored(spark, c, tmp_path)
    numbers = [[v for r in z for v in (r.prediction, r.impurity, r.gain, *r.impurityStats)] for z in (x, y)]
    return [*map(shape, x)] == [*map(shape, y)] and np.allclose(*numbers, rtol=1e-9, atol=1e-9) and a.treeWeights == c.treeWeights


@pytest.mark.parametrize("params", [
    {"n_estimators": 6, "max_depth": 4},
    {"n_estimators": 3, "max_depth": 7, "subsample": 0.65, "colsample_bytree": 0.6, "min_child_weight": 9, "gamma": 0.002},
    {"n_estimators": 3, "max_depth": -1, "num_leaves": 31, "min_child_samples": 20, "subsample": 1.0, "colsample_bytree": 1.0},
    {"n_estimators": 3, "max_depth": 3, "gamma": 50.0},
])
def test_trees_are_those_of_mllib(spark, rows, tmp_path, params):
    ours = m.boosted_trees(params)
    assert equal_trees(spark, ours.fit(rows), mllib(ours, rows), tmp_path)


def test_fewer_rows_are_not_sampled(spark, rows, tmp_path):
    few = rows.filter("id % 40 = 0")
    ours = m.boosted_trees({"n_estimators": 4, "max_depth": 5})
    assert equal_trees(spark, ours.fit(few), mllib(ours, few), tmp_path)


def test_more_rows_than_a_task_may_hold_are_left_to_mllib(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(b, "ROWS_IN_ONE_TASK", 5_000)
    ours = m.boosted_trees({"n_estimators": 2, "max_depth": 3})
    grown = []
    monkeypatch.setattr(b, "_task", lambda spec: grown.append(spec))
    assert equal_trees(spark, ours.fit(rows), mllib(ours, rows), tmp_path) and not grown


def test_a_fit_takes_few_jobs(spark, rows):
    """MLlib takes a job for each level of each tree: 100 here."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "fit")
    try:
        model = m.boosted_trees({"n_estimators": 25, "max_depth": 4}).fit(rows)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert model.getNumTrees == 25 and model.numFeatures == 6 and model.getMaxIter() == 25
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 25


def test_nodes_by_slices_change_nothing(monkeypatch):
    random = np.random.default_rng(5)
    x = np.column_stack([random.normal(size=900), random.integers(0, 2, 900)])
    y, w = np.where(x[:, 0] + x[:, 1] + random.normal(size=900) > 0, 1.0, -1.0), random.uniform(0.5, 2, 900)
    spec = b.Spec([b.thresholds(x[:, 0], w, w.sum(), 16), None], 3, 6, 0.1, 1, 0.8, 2, 2, 0.0)
    whole = [t.rows(0, spec.cuts) for t in b.grow(spec, b.binned(spec, x), y, w)]
    monkeypatch.setattr(b, "_HELD_BYTES", 1)
    assert [t.rows(0, spec.cuts) for t in b.grow(spec, b.binned(spec, x), y, w)] == whole


def test_columns_that_tell_the_same_rows_apart_are_counted_once():
    """A column, its opposite, a copy with empty bins, another one: sums under the bins of each are those counted directly."""
    random = np.random.default_rng(6)
    flag = random.integers(0, 2, 500)
    bins = np.column_stack([flag, 1 - flag, 3 * flag, random.integers(0, 5, 500)]).astype(np.uint8)
    widths, node, weight = np.array([2, 2, 4, 6]), random.integers(0, 3, 500), random.uniform(size=500)
    known = b.patterns(bins, widths)
    assert known.codes.shape[1] == 2 and known.column.tolist() == [0, 0, 0, 1]
    got = b._histograms(known, known.codes, node, [weight, weight, weight], 3)
    want = [[weight[(node == k) & (bins[:, f] == v)] for f, width in enumerate(widths) for v in range(width)] for k in range(3)]
    assert np.allclose(got[0], [[w.sum() for w in row] for row in want]) and got[3].tolist() == [[len(w) for w in row] for row in want]


def test_draws_are_those_of_spark(spark):
    for seed in (-3, 0, 7, 1 << 40):
        java = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        assert b.uniforms([1, seed], 300)[1].tolist() == [java.nextDouble() for _ in range(300)]
        assert b.xorshift_int(seed) == spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()


def test_other_categories_are_left_to_mllib(spark, tmp_path):
    df = spark.createDataFrame([(float(i % 3), float(i % 3 == 1)) for i in range(60)], "c double, label double").withColumn(m.WEIGHT, F.lit(1.0)).coalesce(1)
    df = df.withColumn("c", F.col("c").alias("c", metadata={"ml_attr": {"type": "nominal", "name": "c", "vals": ["x", "y", "z"]}}))
    df = VectorAssembler(inputCols=["c"], outputCol="features").transform(df)
    ours = m.boosted_trees({"n_estimators": 2, "max_depth": 2, "subsample": 1.0})
    assert equal_trees(spark, ours.fit(df), mllib(ours, df), tmp_path)


def test_odd_rows_are_refused(spark):
    df = spark.createDataFrame([(2.0, 1.0, 0.0), (1.0, 1.0, 1.0)], "label double, weight double, x double")
    with pytest.raises(Exception):
        m.boosted_trees({"n_estimators": 1}).fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(df))
