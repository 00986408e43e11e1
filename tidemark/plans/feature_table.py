"""Raw tables to the subscription feature table, with reusable stages and optional test split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import in_hash_sample
from ..operators import subscription as sub
from ..operators.quantiles import add_capped_columns
from ..operators.splits import SplitSpec, assign
from ..session import fresh_path
from ..sources.sinks import ensure_split, split_paths, stage, write_split
from ..sources.tables import path_exists, read_labels, read_logs, read_members, read_table, read_transactions


def sampled(raw: DataFrame, fraction: float | None, method: str = "xxhash64") -> DataFrame:
    """The same users on every table; the filter sits on the scan, before any shuffle."""
    return raw if fraction is None else raw.filter(in_hash_sample(F.col("msno"), fraction, method))


def recap(spark: SparkSession, base_path: str | None, output: str, add_capped: bool = True) -> DataFrame:
    """Recompute only the capped columns from an existing base table."""
    if base_path is None or not path_exists(spark, base_path):
        raise ValueError("recapping needs an existing base table")
    base = read_table(spark, base_path)
    (add_capped_columns(base) if add_capped else base).write.mode("overwrite").parquet(output)
    return spark.read.parquet(output)


def build_feature_table(
    spark: SparkSession,
    labels: str,
    members: str,
    transactions: str,
    logs: str,
    output: str,
    base_output: str | None = None,
    stage_dir: str | None = None,
    sample_fraction: float | None = None,
    add_capped: bool = True,
    reuse: bool = True,
    recap_only: bool = False,
    split_config: dict | None = None,
    split_test: bool = False,
    test_output: str | None = None,
) -> DataFrame:
    """Build, cap, write and optionally split the feature table; returns the written table.

    The two per-user feature frames are stages: the join and the anchor both read them, and an
    interrupted build resumes after them. The base table is a stage too, as the caps read it
    several times.
    """
    if sample_fraction is not None and not 0 < float(sample_fraction) <= 1:
        raise ValueError("sample_fraction must be in (0, 1]")
    spec = None if split_config is None else SplitSpec.configured(split_config, parts=2, date_col="latest_transaction_date")
    if split_test and reuse and ensure_split(spark, output, spec, "is_churn", "msno", test_output):
        return spark.read.parquet(output)
    if recap_only:
        return recap(spark, base_output, output, add_capped)

    stage_dir = stage_dir or fresh_path(spark, "feature-stages")
    txn = sub.clean_transactions(sampled(read_transactions(spark, transactions), sample_fraction))
    log = sub.add_daily_metrics(sub.clean_logs(sampled(read_logs(spark, logs), sample_fraction)))
    txn_features = stage(spark, f"{stage_dir}/transaction_features", lambda: sub.transaction_features(txn), reuse)
    log_features = stage(spark, f"{stage_dir}/log_features", lambda: sub.log_features(log), reuse)

    def base() -> DataFrame:
        return sub.assemble_features(
            sub.clean_labels(sampled(read_labels(spark, labels), sample_fraction)),
            sub.clean_members(sampled(read_members(spark, members), sample_fraction)),
            txn_features,
            log_features,
            sub.feature_anchor(txn_features, log_features, "last_transaction_date", "last_log_date"),
        )

    base_table = stage(spark, base_output or f"{stage_dir}/base_features", base, reuse)
    final = add_capped_columns(base_table) if add_capped else base_table
    final.write.mode("overwrite").parquet(output)
    table = spark.read.parquet(output)
    if split_test:
        if spec is None:
            raise ValueError("split_test needs a split config")
        write_split(assign(table, spec, "is_churn", "msno"), *split_paths(output, test_output))
    return table
