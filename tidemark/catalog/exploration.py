"""Exploratory profiles over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as pr
from ..operators import subscription as sub
from .bindings import bind, cte, table
from .registry import query, rounded, rounded_sql
from .subscription import LOGS, SCORED_LOGS

_MOMENTS = ["mean", "std", "min", "max", "skew"]
_CUSTOMER = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")]


def _profile_sql(columns, source: str) -> str:
    parts = []
    for c, t in columns:
        numeric = t != "string"
        moments = (
            f"avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, skewness({c}) AS skew"
            if numeric else ", ".join(f"CAST(NULL AS DOUBLE) AS {m}" for m in _MOMENTS)
        )
        kind = "'numeric'" if numeric else f"CASE WHEN count(DISTINCT {c}) <= 10 THEN 'categorical' ELSE 'high_cardinality' END"
        top = f"(SELECT {{}} FROM (SELECT {c} AS v, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1) g ORDER BY n DESC, v LIMIT 1)"
        parts.append(
            f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) - count({c}) AS missing_count, round((count(*) - count({c})) * 100.0 / count(*), 2)::DOUBLE AS missing_pct,"
            f" {moments}, count(DISTINCT {c}) AS unique_values, {top.format('n')} AS top_freq, CAST({top.format('v')} AS VARCHAR) AS top_value, {kind} AS feature_type FROM {source}"
        )
    return "\nUNION ALL ".join(parts)


@query("n1_column_profile", rounded_sql("--SELECT\n" + _profile_sql(_CUSTOMER, "customer"), _MOMENTS))
def n1_column_profile(spark, sf):
    return rounded(pr.column_profile(table(spark, sf, "customer")), _MOMENTS)


_TELCO = "WITH " + cte("b_telco")
_CATEGORIES = ["Contract", "InternetService", "OnlineSecurity", "PaymentMethod", "tenure"]


def _telco(spark, sf):
    return bind(spark, sf, "b_telco").withColumn("ChurnFlag", (F.col("Churn") == "Yes").cast("int"))


@query("n2_rate_by_category", rounded_sql(_TELCO + "\n--SELECT\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, avg(CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END) AS rate, count(*) AS n FROM b_telco GROUP BY {c}" for c in _CATEGORIES), ["rate"]))
def n2_rate_by_category(spark, sf):
    return rounded(pr.rate_by_category(_telco(spark, sf), _CATEGORIES, "ChurnFlag"), ["rate"])


@query("n3_category_counts", _TELCO + "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, Churn, count(*) AS n FROM b_telco GROUP BY {c}, Churn" for c in _CATEGORIES))
def n3_category_counts(spark, sf):
    return pr.counts_by_category(_telco(spark, sf), _CATEGORIES, "Churn")


@query("n4_histogram", rounded_sql("""WITH e AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem)
--SELECT
SELECT l_returnflag, bin, n, lo + bin * (hi - lo) / 30 AS bin_start, lo + (bin + 1) * (hi - lo) / 30 AS bin_end FROM
(SELECT l_returnflag, CAST(least(floor((l_quantity - lo) * 30 / (hi - lo)), 29) AS INT) AS bin, count(*) AS n FROM lineitem, e GROUP BY 1, 2) b, e""", ["bin_start", "bin_end"]))
def n4_histogram(spark, sf):
    return rounded(pr.histogram(table(spark, sf, "lineitem"), "l_quantity", 30, "l_returnflag"), ["bin_start", "bin_end"])


_L = "WITH " + cte("b_logs") + ",\n" + LOGS
_LOG_COLUMNS = ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs"]


def _logs(spark, sf):
    return sub.clean_logs(bind(spark, sf, "b_logs"))


_PERCENTILES = [0.5, 0.75, 0.9, 0.95, 0.99]
_DESCRIBED = ["mean", "std", "min", "max"] + [f"p{p * 100:g}" for p in _PERCENTILES]


@query("n5_describe", rounded_sql(_L + "\n--SELECT\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, "
    + ", ".join(f"quantile_cont({c}, {p}) AS p{p * 100:g}" for p in _PERCENTILES) + " FROM l_clean" for c in _LOG_COLUMNS), _DESCRIBED))
def n5_describe(spark, sf):
    return rounded(pr.describe_columns(_logs(spark, sf), _LOG_COLUMNS), _DESCRIBED)


_M = "WITH " + cte("b_members") + ",\nages AS (SELECT msno, TRY_CAST(bd AS INT) AS bd FROM b_members)"
_SHARES = ["share_below", "share_above", "share_missing_after"]


def _ages(spark, sf):
    return bind(spark, sf, "b_members").select("msno", F.col("bd").try_cast("int").alias("bd"))


@query("n6_outlier_share", rounded_sql(_M + "\n--SELECT\nSELECT avg(CAST(coalesce(bd < 0, false) AS INT)) AS share_below, avg(CAST(coalesce(bd > 80, false) AS INT)) AS share_above,"
    " avg(CAST(NOT coalesce(bd BETWEEN 0 AND 80, false) AS INT)) AS share_missing_after FROM ages", _SHARES))
def n6_outlier_share(spark, sf):
    return rounded(pr.outlier_share(_ages(spark, sf), "bd", 0, 80), _SHARES)


@query("n6_outliers_to_null", _M + "\nSELECT msno, CASE WHEN bd BETWEEN 0 AND 80 THEN bd END AS bd FROM ages")
def n6_outliers_to_null(spark, sf):
    return pr.outliers_to_null(_ages(spark, sf), "bd", 0, 80)


@query("n7_correlation", rounded_sql(_L + "\n--SELECT\n" + " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS correlation FROM l_clean" for a in _LOG_COLUMNS for b in _LOG_COLUMNS), ["correlation"]))
def n7_correlation(spark, sf):
    return rounded(pr.correlation_matrix(_logs(spark, sf), _LOG_COLUMNS), ["correlation"])


@query("n8_daily_total", rounded_sql("--SELECT\nSELECT CAST(ts AS DATE) AS day, sum(value) AS total FROM events GROUP BY 1", ["total"]))
def n8_daily_total(spark, sf):
    return rounded(pr.daily_total(table(spark, sf, "events").withColumn("day", F.to_date("ts")), "day", "value"), ["total"])


@query("n9_user_profile", rounded_sql(_L + ",\n" + SCORED_LOGS + "\n--SELECT\nSELECT msno, " + ", ".join(f"avg({c}) AS {c}" for c in pr.LISTENER_METRICS) + " FROM l_scored GROUP BY msno", pr.LISTENER_METRICS))
def n9_user_profile(spark, sf):
    return rounded(pr.user_profile(sub.add_daily_metrics(_logs(spark, sf))), pr.LISTENER_METRICS)


@query("n13_time_series", _L + "\nSELECT msno, log_date, total_secs FROM l_clean WHERE msno = '42'")
def n13_time_series(spark, sf):
    return pr.time_series(_logs(spark, sf), "msno", "42", "log_date").select("msno", "log_date", "total_secs")


_UNGUARDED = ["completion_rate", "skip_rate", "repeat_ratio", "avg_song_secs"]


@query("n14_unguarded_ratios", rounded_sql(_L + "\n--SELECT\nSELECT msno, log_date, num_100 / nullif(s, 0) AS completion_rate, num_25 / nullif(s, 0) AS skip_rate, 1 - num_unq / nullif(s, 0) AS repeat_ratio,"
    " total_secs / nullif(s, 0) AS avg_song_secs FROM (SELECT *, num_25 + num_50 + num_75 + num_985 + num_100 AS s FROM l_clean) p", _UNGUARDED))
def n14_unguarded_ratios(spark, sf):
    return rounded(sub.add_daily_metrics(_logs(spark, sf), guarded=False).select("msno", "log_date", *_UNGUARDED), _UNGUARDED)


_BOX = ["q1", "median", "q3", "lower_fence", "upper_fence"]
_BOXED = ["l_quantity", "l_extendedprice"]


@query("n15_box_stats", rounded_sql("--SELECT\nSELECT *, q1 - (q3 - q1) * 1.5 AS lower_fence, q3 + (q3 - q1) * 1.5 AS upper_fence FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM lineitem" for c in _BOXED) + ") q", _BOX))
def n15_box_stats(spark, sf):
    return rounded(pr.box_stats(table(spark, sf, "lineitem"), _BOXED), _BOX)


@query("n16_date_range", _L + "\nSELECT min(log_date) AS first_date, max(log_date) AS last_date FROM l_clean")
def n16_date_range(spark, sf):
    return pr.date_range(_logs(spark, sf), "log_date")


_NULLABLE = ["customerID", "OnlineSecurity", "PaymentMethod", "TotalCharges"]


@query("n17_null_counts", _TELCO + "\n" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count FROM b_telco" for c in _NULLABLE))
def n17_null_counts(spark, sf):
    return pr.null_counts(bind(spark, sf, "b_telco").select(*_NULLABLE))
