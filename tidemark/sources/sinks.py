"""Writers: stages, split tables, predictions, reports and metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.splits import SplitSpec, assign
from .tables import path_exists, read_table


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame], reuse: bool = True) -> DataFrame:
    """A named stage as a Parquet table: read it when complete and reusable, else (re)build it."""
    if not (reuse and path_exists(spark, f"{path}/_SUCCESS")):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def split_paths(base: str, explicit_test: str | None = None) -> tuple[str, str]:
    """(train, test) paths next to the base table."""
    folder, _, name = base.rstrip("/").rpartition("/")
    stem = f"{folder}/{name.rsplit('.', 1)[0]}"
    return f"{stem}_train.parquet", explicit_test or f"{stem}_test.parquet"


def write_split(df: DataFrame, train_path: str, test_path: str) -> None:
    """Write the train and test parts of a frame that has a ``split`` column."""
    for part, path in (("train", train_path), ("test", test_path)):
        df.filter(F.col("split") == part).drop("split").write.mode("overwrite").parquet(path)


def ensure_split(spark: SparkSession, table_path: str, spec: SplitSpec | None, label: str, id_col: str, test_path: str | None = None) -> bool:
    """Whether the table at ``table_path`` exists; if it does, its two parts do too afterwards."""
    parts = split_paths(table_path, test_path)
    if not path_exists(spark, table_path):
        return False
    if all(path_exists(spark, p) for p in parts):
        return True
    if spec is None:
        raise ValueError(f"{table_path} is to be split, but nothing says how")
    write_split(assign(read_table(spark, table_path), spec, label, id_col), *parts)
    return True


def write_test_artifacts(test: DataFrame, id_col: str, directory: str) -> None:
    """The test ids and the full test rows, each as Parquet and CSV."""
    ids = test.select(F.col(id_col).alias("row_id"), F.col(id_col))
    for name, df in (("test_ids", ids), ("test_set", test)):
        df.write.mode("overwrite").parquet(f"{directory}/splits/{name}.parquet")
        df.write.mode("overwrite").option("header", True).csv(f"{directory}/splits/{name}.csv")


def write_report_csv(df: DataFrame, path: str) -> None:
    """A small report (metric rows, candidates, importances) as one CSV with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_scored_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_predictions(scored: DataFrame, path: str) -> None:
    """Append one scoring run; the newest run is found by its stamp, not by a second copy."""
    scored.withColumn("scored_date", F.to_date("scored_at")).write.mode("append").partitionBy("scored_date").parquet(path)


def write_metadata(df: DataFrame, path: str) -> None:
    """A one-row frame as JSON."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_causal_bundle(bundle: dict[str, DataFrame], directory: str) -> None:
    write_metadata(bundle["summary"], f"{directory}/summary.json")
    for key, name in (("cate", "cate"), ("uplift_table", "uplift_table"), ("policy", "policy_recommendations")):
        if bundle.get(key) is not None:
            write_report_csv(bundle[key], f"{directory}/{name}.csv")
