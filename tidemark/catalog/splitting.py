"""Train/dev/test splits and saved splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import subscription as sub
from ..operators.splits import SavedSplit, SplitSpec, assign, test_rows
from .bindings import bind, cte
from .registry import query
from .subscription import TXN_LATEST, TXN_LINKED, transactions_cte

_SCORED = "WITH " + cte("b_scored")
# Test share left by .70 train and .15 dev, in doubles as the sizes are resolved.
_TEST = "(1.0::DOUBLE - 0.7::DOUBLE - 0.15::DOUBLE)"


def stratified_sql(dev: bool, seed: int = 42, test: str = _TEST) -> str:
    """Largest-remainder shares per class, drawn in order of a 60-bit md5 key."""
    def share(total: str, count: str, n: str) -> str:
        return f"CAST({total} * {count} AS DOUBLE) / {n}"

    sql = f""",
drawn AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':{seed}'), 1, 15) AS BIGINT)) AS r FROM b_scored),
per_class AS (SELECT y, count(*) AS c FROM b_scored GROUP BY y),
sized AS (SELECT *, (SELECT sum(c) FROM per_class)::BIGINT AS n, CAST(ceil((SELECT sum(c) FROM per_class)::BIGINT * {test}) AS BIGINT) AS t FROM per_class),
floored AS (SELECT *, {share('t', 'c', 'n')} AS e, CAST(floor({share('t', 'c', 'n')}) AS BIGINT) AS f FROM sized),
tested AS (SELECT *, f + CASE WHEN row_number() OVER (ORDER BY f - e, y) <= t - sum(f) OVER () THEN 1 ELSE 0 END AS k_test FROM floored)"""
    if not dev:
        return sql + "\nSELECT id, y, CASE WHEN r <= k_test THEN 'test' ELSE 'train' END AS split FROM drawn JOIN tested USING (y)"
    return sql + f""",
rest AS (SELECT y, k_test, c - k_test AS c2, sum(c - k_test) OVER ()::BIGINT AS n2 FROM tested),
dev_sized AS (SELECT *, CAST(ceil(n2 * (0.15::DOUBLE / (1.0::DOUBLE - {test}))) AS BIGINT) AS d FROM rest),
dev_floored AS (SELECT *, {share('d', 'c2', 'n2')} AS e2, CAST(floor({share('d', 'c2', 'n2')}) AS BIGINT) AS f2 FROM dev_sized),
parts AS (SELECT *, k_test + f2 + CASE WHEN row_number() OVER (ORDER BY f2 - e2, y) <= d - sum(f2) OVER () THEN 1 ELSE 0 END AS k_dev FROM dev_floored)
SELECT id, y, CASE WHEN r <= k_test THEN 'test' WHEN r <= k_dev THEN 'dev' ELSE 'train' END AS split FROM drawn JOIN parts USING (y)"""


@query("sp1_two_way", _SCORED + stratified_sql(dev=False))
def sp1_two_way(spark, sf):
    spec = SplitSpec.configured({"train_size": 0.7, "dev_size": 0.15}, parts=2)
    return assign(bind(spark, sf, "b_scored"), spec, "y", "id").select("id", "y", "split")


_DATED = "WITH " + cte("b_transactions") + ",\n" + ",\n".join([transactions_cte(), TXN_LINKED, TXN_LATEST])


def _latest(spark, sf):
    latest = sub.latest_transactions(sub.clean_transactions(bind(spark, sf, "b_transactions")))
    return latest.select("msno", "latest_transaction_date", F.lit(0).alias("y"))


@query("sp2_time_two_way", _DATED + "\nSELECT msno, CASE WHEN latest_transaction_date > DATE '2001-06-01' THEN 'test' ELSE 'train' END AS split FROM t_latest WHERE latest_transaction_date IS NOT NULL")
def sp2_time_two_way(spark, sf):
    config = {"strategy": "time", "dev_end": "2001-06-01", "date_col": "latest_transaction_date"}
    return assign(_latest(spark, sf), SplitSpec.configured(config, parts=2), "y", "msno").select("msno", "split")


@query("sp3_time_three_way", _DATED + "\nSELECT msno, CASE WHEN latest_transaction_date > DATE '2001-06-01' THEN 'test' WHEN latest_transaction_date > DATE '2001-03-01' THEN 'dev' ELSE 'train' END AS split FROM t_latest")
def sp3_time_three_way(spark, sf):
    spec = SplitSpec(date_col="latest_transaction_date", test_after="2001-06-01", dev_after="2001-03-01")
    return assign(_latest(spark, sf), spec, "y", "msno").select("msno", "split")


@query("sp4_stratified", _SCORED + stratified_sql(dev=True))
def sp4_stratified(spark, sf):
    return assign(bind(spark, sf, "b_scored"), SplitSpec(), "y", "id").select("id", "y", "split")


@query("sp5_fallback", _SCORED + stratified_sql(dev=True))
def sp5_fallback(spark, sf):
    """A time split whose test part is empty falls back to the stratified one."""
    df = bind(spark, sf, "b_scored").withColumn("day", F.lit("2001-01-01"))
    config = {"fallback": "random", "date_col": "day", "train_end": "2002-01-01", "dev_end": "2003-01-01"}
    out = assign(df, SplitSpec.configured(config, "subscription"), "y", "id")
    return out.select("id", "y", "split")


@query("sp6_test_only", "WITH all_parts AS (" + _SCORED + stratified_sql(dev=False) + ")\nSELECT id, y FROM all_parts WHERE split = 'test'")
def sp6_test_only(spark, sf):
    return test_rows(bind(spark, sf, "b_scored"), SplitSpec(), "y", "id").select("id", "y")


@query("u1_train_and_dev", "WITH all_parts AS (" + _SCORED + stratified_sql(dev=True) + ")\nSELECT split, y, count(*) AS n FROM all_parts WHERE split IN ('train', 'dev') GROUP BY split, y")
def u1_train_and_dev(spark, sf):
    parts = assign(bind(spark, sf, "b_scored"), SplitSpec(), "y", "id")
    return parts.filter("split in ('train', 'dev')").groupBy("split", "y").agg(F.count("*").alias("n"))


_SAVED = _SCORED + ",\nsaved AS (SELECT CAST(id AS STRING) AS row_id, CASE WHEN p >= 0.5 THEN 'Holdout_TEST' ELSE 'train' END AS partition, p >= 0.5 AS is_test FROM b_scored)"


def _saved(spark, sf):
    high = F.col("p") >= 0.5
    return bind(spark, sf, "b_scored").select(
        F.col("id").cast("string").alias("row_id"), F.when(high, "Holdout_TEST").otherwise("train").alias("partition"), high.alias("is_test")
    )


@query("p20_split_filter", _SAVED + "\nSELECT row_id, partition FROM saved WHERE lower(partition) LIKE '%test%'")
def p20_split_filter(spark, sf):
    return SavedSplit(_saved(spark, sf)).test.select("row_id", "partition")


@query("p20_flag_filter", _SAVED + "\nSELECT row_id, is_test FROM saved WHERE is_test")
def p20_flag_filter(spark, sf):
    return SavedSplit(_saved(spark, sf).drop("partition")).test


@query("j3_saved_ids", _SAVED + "\nSELECT id, y, p FROM b_scored WHERE CAST(id AS STRING) IN (SELECT row_id FROM saved WHERE is_test)")
def j3_saved_ids(spark, sf):
    df = bind(spark, sf, "b_scored")
    return SavedSplit(_saved(spark, sf)).select(df, ["p", "absent_feature"], "id", "y", "y").select("id", "y", "p")
