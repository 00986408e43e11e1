"""Readers: raw text tables with fixed schemas, and tables by file suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType, StringType
from pyspark.errors import PySparkException

from ..fixed_values import (
    LABEL_COLUMNS, LOG_COLUMNS, MEMBER_COLUMNS, SAVED_SPLIT_PATHS, TRANSACTION_COLUMNS,
)


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def _read_text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    # Names are matched by header, so a file may order its columns differently.
    return spark.read.schema(text_schema(columns)).option("header", True).option("enforceSchema", False).csv(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return _read_text_csv(spark, path, LABEL_COLUMNS)


def read_members(spark: SparkSession, path: str) -> DataFrame:
    return _read_text_csv(spark, path, MEMBER_COLUMNS)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return _read_text_csv(spark, path, TRANSACTION_COLUMNS)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return _read_text_csv(spark, path, LOG_COLUMNS)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path exists on whichever file system it names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read by suffix: .csv, .parquet or .pq, file or directory.

    String-like columns (VARCHAR, CHAR) come back as STRING; NULL stays NULL.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"input not found: {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if suffix == "csv":
        # Without a schema the types are inferred: small reports only, never the raw tables.
        df = reader.option("header", True).option("inferSchema", schema is None).csv(path)
    elif suffix in ("parquet", "pq"):
        df = reader.parquet(path)
    else:
        raise ValueError(f"unsupported table format: {path}")
    return normalise_strings(df)


def normalise_strings(df: DataFrame) -> DataFrame:
    textual = [n for n, t in df.dtypes if t.startswith(("varchar", "char"))]
    return df.withColumns({n: F.col(n).cast("string") for n in textual}) if textual else df


def read_optional(spark: SparkSession, path: str, schema: StructType | str, fmt: str | None = None) -> DataFrame:
    """The table at ``path``, or an empty one of ``schema`` when nothing is there."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    if fmt == "json":
        return spark.read.schema(schema).json(path)
    return read_table(spark, path, StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def find_saved_split(spark: SparkSession, directory: str) -> tuple[str, DataFrame] | tuple[None, None]:
    """The first readable saved test split among the known places in ``directory``."""
    for relative in SAVED_SPLIT_PATHS:
        path = f"{directory.rstrip('/')}/{relative}"
        if path_exists(spark, path):
            try:
                return path, read_table(spark, path)
            except (PySparkException, ValueError):  # unreadable: the next place may do
                continue
    return None, None


def read_latest_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The most recent scoring run of a predictions table partitioned by day."""
    runs = spark.read.parquet(path)
    newest_day = runs.agg(F.max("scored_date")).scalar()
    in_day = runs.filter(F.col("scored_date") == newest_day)
    return in_day.filter(F.col("scored_at") == in_day.agg(F.max("scored_at")).scalar())
