import pytest
from pyspark.sql import functions as F

from tidemark.catalog.bindings import bind
from tidemark.plans.feature_table import build_feature_table, recap
from tidemark.session import materialise, shared_dir
from tidemark.sources import sinks, tables

CONFIG = {"train_size": 0.7, "dev_size": 0.15}


def test_read_table_dispatch(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, s string")
    for name in ("t.parquet", "t.pq"):
        df.write.parquet(f"{tmp_path}/{name}")
        assert sorted(tables.read_table(spark, f"{tmp_path}/{name}").collect(), key=lambda r: r.a) == [(1, "x"), (2, None)]
    df.write.option("header", True).csv(f"{tmp_path}/t.csv")
    assert tables.read_table(spark, f"{tmp_path}/t.csv").columns == ["a", "s"]
    df.write.json(f"{tmp_path}/t.txt")
    with pytest.raises(ValueError):
        tables.read_table(spark, f"{tmp_path}/t.txt")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, f"{tmp_path}/missing.csv")


def test_stage_reuses_and_rebuilds(spark, tmp_path):
    path = f"{tmp_path}/stage"
    sinks.stage(spark, path, lambda: spark.range(3))
    assert sinks.stage(spark, path, lambda: spark.range(9)).count() == 3
    assert sinks.stage(spark, path, lambda: spark.range(9), reuse=False).count() == 9


def test_split_paths():
    assert sinks.split_paths("/a/b/base.parquet") == ("/a/b/base_train.parquet", "/a/b/base_test.parquet")
    assert sinks.split_paths("/a/b/base.parquet", "/z.parquet")[1] == "/z.parquet"


def test_optional_and_saved_split(spark, tmp_path):
    assert tables.read_optional(spark, f"{tmp_path}/none.json", "a int", "json").count() == 0
    assert tables.find_saved_split(spark, str(tmp_path)) == (None, None)
    spark.createDataFrame([(1,)], "row_id int").write.parquet(f"{tmp_path}/test_set.parquet")
    assert tables.find_saved_split(spark, str(tmp_path))[0].endswith("test_set.parquet")
    spark.createDataFrame([(2,)], "row_id int").write.parquet(f"{tmp_path}/splits/test_ids.parquet")
    assert tables.find_saved_split(spark, str(tmp_path))[1].first().row_id == 2


def test_feature_build_end_to_end(spark, sf, tmp_path):
    paths = []
    for b in ("b_label", "b_members", "b_transactions", "b_logs"):
        paths.append(f"{tmp_path}/{b}.csv")
        bind(spark, sf, b).write.option("header", True).csv(paths[-1])
    out, base = f"{tmp_path}/features.parquet", f"{tmp_path}/base.parquet"
    table = build_feature_table(spark, *paths, out, base_output=base, split_test=True, split_config=CONFIG)
    assert len(table.columns) == 107 and table.count() == bind(spark, sf, "b_label").count()
    train, test = (spark.read.parquet(p) for p in sinks.split_paths(out))
    assert train.count() + test.count() == table.count() and not train.join(test, "msno").count()
    # a second call finds everything in place
    assert build_feature_table(spark, *paths, out, base_output=base, split_test=True, split_config=CONFIG).count() == table.count()
    assert len(recap(spark, base, f"{tmp_path}/recapped").columns) == 107
    with pytest.raises(ValueError):
        recap(spark, f"{tmp_path}/nothing", f"{tmp_path}/x")
    with pytest.raises(ValueError):
        build_feature_table(spark, *paths, out, sample_fraction=1.5)
    sampled = build_feature_table(spark, *paths, f"{tmp_path}/sampled.parquet", sample_fraction=0.4)
    assert 0 < sampled.count() < table.count()
    keys = sampled.select("msno")
    assert sampled.select("msno", "txn_count").exceptAll(table.join(keys, "msno", "left_semi").select("msno", "txn_count")).count() == 0


def test_csv_columns_in_another_order(spark, tmp_path):
    bad = spark.createDataFrame([("1", "a")], "is_churn string, msno string")
    bad.write.option("header", True).csv(f"{tmp_path}/labels.csv")
    with pytest.raises(Exception):  # a differing header is refused, never read by position
        tables.read_labels(spark, f"{tmp_path}/labels.csv").collect()


def test_latest_run(spark, tmp_path):
    path = f"{tmp_path}/predictions"
    for stamp, p in (("2024-01-01 23:00:00", 0.1), ("2024-01-02 01:00:00", 0.2), ("2024-01-02 05:00:00", 0.3)):
        sinks.append_predictions(spark.createDataFrame([(1, p)], "id int, p double").withColumn("scored_at", F.lit(stamp).cast("timestamp")), path)
    assert [r.p for r in tables.read_latest_predictions(spark, path).collect()] == [0.3]


def test_stages_land_in_the_shared_folder(spark):
    df = materialise(spark.range(5), "probe")
    assert df.count() == 5 and shared_dir(spark).split(":")[-1] in df.inputFiles()[0]
