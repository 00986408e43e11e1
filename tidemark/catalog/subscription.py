"""Subscription cleaning, features, joins and caps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import CAPPED_COLUMNS
from ..functions.columns import compact_date, in_hash_sample
from ..operators import subscription as sub
from ..operators.quantiles import add_capped_columns, exact_quantiles
from ..operators.splits import find_id_column, validate_features
from ..plans.train import sample_rows
from ..session import materialise
from .bindings import bind, cte
from .registry import query, rounded, rounded_sql

# ---------------------------------------------------------------- SQL building blocks

MEMBERS = """m_clean AS (
 SELECT msno, CASE WHEN city_n BETWEEN 1 AND 25 THEN city_n END AS city,
  CASE WHEN age_n BETWEEN 10 AND 100 THEN age_n END AS age,
  CAST(CASE WHEN age_n BETWEEN 10 AND 100 THEN 0 ELSE 1 END AS INT) AS age_missing_or_invalid,
  CAST(coalesce(g = 'male', false) AS INT) AS gender_male, CAST(coalesce(g = 'female', false) AS INT) AS gender_female,
  CAST(coalesce(g, '') = '' AS INT) AS gender_missing, via_n AS registered_via,
  CAST(TRY_STRPTIME(registration_init_time, '%Y%m%d') AS DATE) AS registration_init_date
 FROM (SELECT *, TRY_CAST(city AS INT) AS city_n, TRY_CAST(bd AS INT) AS age_n, TRY_CAST(registered_via AS INT) AS via_n,
   lower(trim(gender)) AS g FROM b_members) raw)"""


def transactions_cte(source: str = "b_transactions") -> str:
    return f"""t_clean AS (
 SELECT msno, CASE WHEN method_n >= 0 THEN method_n END AS payment_method_id,
  CASE WHEN days_n BETWEEN 0 AND 3650 THEN days_n END AS payment_plan_days,
  CASE WHEN list_n BETWEEN 0 AND 100000 THEN list_n END AS plan_list_price,
  CASE WHEN paid_n BETWEEN 0 AND 100000 THEN paid_n END AS actual_amount_paid,
  CASE WHEN renew_n IN (0, 1) THEN renew_n ELSE 0 END AS is_auto_renew, day_n AS transaction_date, expire_n AS membership_expire_date,
  CASE WHEN cancel_n IN (0, 1) THEN cancel_n ELSE 0 END AS is_cancel
 FROM (SELECT *, TRY_CAST(payment_method_id AS INT) AS method_n, TRY_CAST(payment_plan_days AS DOUBLE) AS days_n,
   TRY_CAST(plan_list_price AS DOUBLE) AS list_n, TRY_CAST(actual_amount_paid AS DOUBLE) AS paid_n,
   TRY_CAST(is_auto_renew AS INT) AS renew_n, TRY_CAST(is_cancel AS INT) AS cancel_n,
   CAST(TRY_STRPTIME(transaction_date, '%Y%m%d') AS DATE) AS day_n, CAST(TRY_STRPTIME(membership_expire_date, '%Y%m%d') AS DATE) AS expire_n
   FROM {source}) raw
 WHERE day_n IS NOT NULL)"""


_counts = ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq"]
LOGS = (
    "l_clean AS (\n SELECT msno, day_n AS log_date, "
    + ", ".join(f"CASE WHEN {c}_n BETWEEN 0 AND 100000 THEN {c}_n ELSE 0 END AS {c}" for c in _counts)
    + ",\n  CASE WHEN secs_n BETWEEN 0 AND 86400 THEN secs_n ELSE 0 END AS total_secs\n FROM (SELECT *, "
    + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}_n" for c in _counts)
    + ", TRY_CAST(total_secs AS DOUBLE) AS secs_n,\n   CAST(TRY_STRPTIME(date, '%Y%m%d') AS DATE) AS day_n FROM b_logs) raw\n WHERE day_n IS NOT NULL)"
)
_per_song = {"completion_rate": "num_100", "skip_rate": "num_25", "near_completion_rate": "num_985", "avg_song_secs": "total_secs"}
SCORED_LOGS = (
    "l_played AS (SELECT *, num_25 + num_50 + num_75 + num_985 + num_100 AS songs_played FROM l_clean),\n"
    "l_rates AS (SELECT *, "
    + ", ".join(f"CASE WHEN songs_played > 0 THEN {v} / songs_played ELSE 0.0 END AS {k}" for k, v in _per_song.items())
    + ",\n  CASE WHEN songs_played > 0 THEN 1 - num_unq / songs_played ELSE 0.0 END AS repeat_ratio,"
    "\n  CASE WHEN num_unq > 0 THEN total_secs / num_unq ELSE 0.0 END AS secs_per_unique FROM l_played),\n"
    "l_scored AS (SELECT *, completion_rate * 0.6 + near_completion_rate * 0.3 - skip_rate * 0.4 AS quality_score FROM l_rates)"
)

ORDER = "transaction_date, membership_expire_date NULLS FIRST, plan_list_price NULLS FIRST, actual_amount_paid NULLS FIRST"
TXN_LINKED = f"""t_linked AS (
 SELECT *, lag(transaction_date) OVER w AS prev_transaction_date, lag(membership_expire_date) OVER w AS prev_expire_date,
  lead(transaction_date) OVER w IS NULL AS is_latest
 FROM t_clean WINDOW w AS (PARTITION BY msno ORDER BY {ORDER}))"""
TXN_FEATURES = """t_features AS (
 SELECT msno, count(*) AS txn_count, min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date,
  max(membership_expire_date) AS max_membership_expire_date, avg(payment_plan_days) AS avg_payment_plan_days,
  max(payment_plan_days) AS max_payment_plan_days, sum(plan_list_price) AS total_list_price, sum(actual_amount_paid) AS total_amount_paid,
  avg(actual_amount_paid) AS avg_amount_paid, max(actual_amount_paid) AS max_amount_paid, avg(is_auto_renew) AS auto_renew_rate,
  avg(is_cancel) AS cancel_rate, CAST(sum(is_cancel) AS BIGINT) AS cancel_count,
  avg(actual_amount_paid / plan_list_price) FILTER (WHERE plan_list_price > 0) AS avg_paid_to_list_ratio,
  avg(date_diff('day', prev_transaction_date, transaction_date)) AS avg_days_between_transactions,
  avg(date_diff('day', prev_expire_date, transaction_date)) AS avg_gap_from_prev_expire_to_txn,
  count(*) FILTER (WHERE transaction_date > prev_expire_date) AS post_expiry_renewal_count,
  count(*) FILTER (WHERE transaction_date <= prev_expire_date) AS early_renewal_count
 FROM t_linked GROUP BY msno)"""
_latest = ["payment_method_id", "payment_plan_days", "plan_list_price", "actual_amount_paid", "is_auto_renew", "is_cancel", "membership_expire_date", "transaction_date"]
TXN_LATEST = "t_latest AS (SELECT msno, " + ", ".join(f"{c} AS latest_{c}" for c in _latest) + " FROM t_linked WHERE is_latest)"

_log_stats = {
    "songs_played": ("sum", "avg", "std"), "total_secs": ("sum", "avg", "std"), "num_unq": ("sum", "avg"),
    "completion_rate": ("avg", "std"), "skip_rate": ("avg", "std"), "near_completion_rate": ("avg",), "repeat_ratio": ("avg",),
    "avg_song_secs": ("avg",), "secs_per_unique": ("avg",), "quality_score": ("avg",),
}
_sql_name = {"sum": "sum", "avg": "avg", "std": "stddev_samp"}
LOG_FEATURES = (
    "l_features AS (SELECT msno, count(*) AS log_day_count, min(log_date) AS first_log_date, max(log_date) AS last_log_date, "
    + ", ".join(f"{_sql_name[k]}({c}) AS {c}_{k}" for c, kinds in _log_stats.items() for k in kinds)
    + ", max(total_secs) AS max_total_secs_day, max(songs_played) AS max_songs_played_day FROM l_scored GROUP BY msno)"
)
LATEST_LOG_VALUES = ["songs_played", "total_secs", "num_unq", "completion_rate", "skip_rate", "near_completion_rate", "repeat_ratio", "avg_song_secs", "secs_per_unique", "quality_score"]
LOG_LATEST = (
    "l_latest AS (SELECT msno, log_date AS latest_log_date, " + ", ".join(f"{c} AS latest_{c}" for c in LATEST_LOG_VALUES)
    + " FROM l_scored QUALIFY row_number() OVER (PARTITION BY msno ORDER BY log_date DESC) = 1)"
)
ANCHOR = """anchor AS (
 SELECT greatest(coalesce((SELECT max(log_date) FROM l_clean), DATE '1970-01-01'),
  coalesce((SELECT max(transaction_date) FROM t_clean), DATE '1970-01-01')) AS feature_anchor_date)"""

_deltas = {"total_secs": "total_secs", "songs": "songs_played", "completion": "completion_rate", "skip": "skip_rate", "quality": "quality_score"}
BASE = (
    "joined AS (SELECT b.*, m.* EXCLUDE (msno), m.msno AS member_key, t.* EXCLUDE (msno), x.* EXCLUDE (msno), l.* EXCLUDE (msno), y.* EXCLUDE (msno), feature_anchor_date AS day0\n"
    " FROM b_label b LEFT JOIN m_clean m USING (msno) LEFT JOIN t_features t USING (msno) LEFT JOIN t_latest x USING (msno)\n"
    " LEFT JOIN l_features l USING (msno) LEFT JOIN l_latest y USING (msno), anchor),\n"
    "base AS (SELECT * EXCLUDE (member_key, day0) REPLACE ("
    + ", ".join(f"coalesce({c}_std, 0) AS {c}_std" for c in ("songs_played", "total_secs", "completion_rate", "skip_rate"))
    + "),\n date_diff('day', last_log_date, day0) AS days_since_last_log, date_diff('day', last_transaction_date, day0) AS days_since_last_transaction,\n"
    " date_diff('day', day0, max_membership_expire_date) AS days_until_membership_expire, date_diff('day', registration_init_date, day0) AS account_age_days,\n"
    " date_diff('day', first_transaction_date, last_transaction_date) AS subscription_history_days, date_diff('day', first_log_date, last_log_date) + 1 AS observed_log_span_days,\n "
    + ", ".join(f"coalesce(latest_{v}, 0) - coalesce({v}_avg, 0) AS latest_vs_avg_{k}_delta" for k, v in _deltas.items())
    + ",\n CASE WHEN songs_played_avg > 0 THEN latest_songs_played / songs_played_avg ELSE 0 END AS latest_to_avg_songs_ratio,"
    " CASE WHEN total_secs_avg > 0 THEN latest_total_secs / total_secs_avg ELSE 0 END AS latest_to_avg_total_secs_ratio,\n"
    " CASE WHEN txn_count > 0 THEN total_amount_paid / txn_count ELSE 0 END AS amount_paid_per_txn,"
    " CASE WHEN log_day_count > 0 THEN total_secs_sum / log_day_count ELSE 0 END AS avg_total_secs_per_logged_day,"
    " CASE WHEN log_day_count > 0 THEN songs_played_sum / log_day_count ELSE 0 END AS avg_songs_per_logged_day,\n "
    + ", ".join(f"CAST(coalesce({cond}, false) AS INT) AS {name}" for name, cond in {
        "membership_active_flag": "max_membership_expire_date >= day0", "latest_cancel_flag": "latest_is_cancel = 1",
        "latest_auto_renew_flag": "latest_is_auto_renew = 1", "has_member_record": "member_key IS NOT NULL",
        "has_transaction_record": "txn_count IS NOT NULL", "has_log_record": "log_day_count IS NOT NULL"}.items())
    + " FROM joined)"
)

_T = "WITH " + cte("b_transactions") + ",\n" + transactions_cte()
_L = "WITH " + cte("b_logs") + ",\n" + LOGS
_LS = _L + ",\n" + SCORED_LOGS
_TF = _T + ",\n" + TXN_LINKED + ",\n" + TXN_FEATURES + ",\n" + TXN_LATEST
BASE_SQL = ",\n".join([
    "WITH " + cte("b_label", "b_members", "b_transactions", "b_logs"), MEMBERS, transactions_cte(), TXN_LINKED, TXN_FEATURES, TXN_LATEST,
    LOGS, SCORED_LOGS, LOG_FEATURES, LOG_LATEST, ANCHOR, BASE,
])


def select(ctes: str, body: str) -> str:
    return f"{ctes}\n--SELECT\n{body}"


def caps_cte(columns=CAPPED_COLUMNS) -> str:
    """The capped columns by SQL, from quantile_cont."""
    ends = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.01) AS {c}_lo, quantile_cont(CAST({c} AS DOUBLE), 0.99) AS {c}_hi" for c in columns)
    clip = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN least(greatest(CAST({c} AS DOUBLE), {c}_lo), {c}_hi) END AS {c}_capped" for c in columns)
    drop = ", ".join(f"{c}_lo, {c}_hi" for c in columns)
    return f"ends AS (SELECT {ends} FROM base),\ncapped AS (SELECT * EXCLUDE ({drop}), {clip} FROM base, ends)"


RATE_COLUMNS = ["completion_rate", "skip_rate", "near_completion_rate", "repeat_ratio", "avg_song_secs", "secs_per_unique", "quality_score"]
TXN_DOUBLES = ["avg_payment_plan_days", "avg_amount_paid", "auto_renew_rate", "cancel_rate", "avg_paid_to_list_ratio", "avg_days_between_transactions", "avg_gap_from_prev_expire_to_txn"]
LOG_DOUBLES = [f"{c}_{k}" for c, kinds in _log_stats.items() for k in kinds if k != "sum"]
LATEST_DOUBLES = [f"latest_{c}" for c in RATE_COLUMNS]
RATIO_DOUBLES = ["latest_to_avg_songs_ratio", "latest_to_avg_total_secs_ratio", "amount_paid_per_txn", "avg_total_secs_per_logged_day", "avg_songs_per_logged_day"]
DELTA_DOUBLES = [f"latest_vs_avg_{k}_delta" for k in _deltas]
BASE_DOUBLES = TXN_DOUBLES + LOG_DOUBLES + LATEST_DOUBLES + RATIO_DOUBLES + DELTA_DOUBLES
CAPPED_DOUBLES = [f"{c}_capped" for c in CAPPED_COLUMNS]


def _base(spark, sf):
    return sub.base_features(*[bind(spark, sf, b) for b in ("b_label", "b_members", "b_transactions", "b_logs")])


def _txn(spark, sf, source="b_transactions"):
    return sub.clean_transactions(bind(spark, sf, source))


def _logs(spark, sf):
    return sub.clean_logs(bind(spark, sf, "b_logs"))


# ---------------------------------------------------------------- cleaning


@query("p1_hash_sample", select("WITH " + cte("b_transactions"),
       "SELECT msno, transaction_date, plan_list_price, actual_amount_paid FROM b_transactions WHERE CAST('0x' || substr(md5(msno), 1, 8) AS BIGINT) % 1000000 < 300000"))
def p1_hash_sample(spark, sf):
    raw = bind(spark, sf, "b_transactions")
    return raw.filter(in_hash_sample(F.col("msno"), 0.3, "md5")).select("msno", "transaction_date", "plan_list_price", "actual_amount_paid")


@query("p2_row_sample", "WITH " + cte("b_scored") + "\nSELECT * FROM b_scored WHERE CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 1000000 < 500000")
def p2_row_sample(spark, sf):
    """A repeatable half of the rows, the sampling operator's own parameter."""
    return sample_rows(bind(spark, sf, "b_scored"), "id", 0.5, method="md5")


@query("p3_members_clean", "WITH " + cte("b_members") + ",\n" + MEMBERS + "\nSELECT * FROM m_clean")
def p3_members_clean(spark, sf):
    return sub.clean_members(bind(spark, sf, "b_members"))


@query("p3_transactions_clean", _T + "\nSELECT * FROM t_clean")
def p3_transactions_clean(spark, sf):
    return _txn(spark, sf)


@query("p4_logs_clean", _L + "\nSELECT * FROM l_clean")
def p4_logs_clean(spark, sf):
    return _logs(spark, sf)


@query("p5_missing_flags", "WITH " + cte("b_members") + ",\n" + MEMBERS + "\nSELECT msno, age_missing_or_invalid, gender_missing FROM m_clean")
def p5_missing_flags(spark, sf):
    return sub.clean_members(bind(spark, sf, "b_members")).select("msno", "age_missing_or_invalid", "gender_missing")


@query("p6_gender_flags", "WITH " + cte("b_members") + ",\n" + MEMBERS + "\nSELECT msno, gender_male, gender_female FROM m_clean")
def p6_gender_flags(spark, sf):
    return sub.clean_members(bind(spark, sf, "b_members")).select("msno", "gender_male", "gender_female")


@query("p7_dates", "WITH " + cte("b_members") + "\nSELECT msno, CAST(TRY_STRPTIME(registration_init_time, '%Y%m%d') AS DATE) AS parsed, CAST(TRY_STRPTIME(bd, '%Y%m%d') AS DATE) IS NULL AS malformed_is_null FROM b_members")
def p7_dates(spark, sf):
    return bind(spark, sf, "b_members").select(
        "msno", compact_date(F.col("registration_init_time")).alias("parsed"), compact_date(F.col("bd")).isNull().alias("malformed_is_null")
    )


@query("p8_dated_rows", _T + "\nSELECT transaction_date, count(*) AS n FROM t_clean GROUP BY transaction_date")
def p8_dated_rows(spark, sf):
    return _txn(spark, sf).groupBy("transaction_date").agg(F.count("*").alias("n"))


@query("p9_daily_metrics", rounded_sql(select(_LS, "SELECT * FROM l_scored"), RATE_COLUMNS))
def p9_daily_metrics(spark, sf):
    return rounded(sub.add_daily_metrics(_logs(spark, sf)), RATE_COLUMNS)


@query("p10_quality_score", rounded_sql(select(_LS, "SELECT msno, log_date, quality_score FROM l_scored"), ["quality_score"]))
def p10_quality_score(spark, sf):
    return rounded(sub.add_daily_metrics(_logs(spark, sf)).select("msno", "log_date", "quality_score"), ["quality_score"])


_RECENCY = ["days_since_last_log", "days_since_last_transaction", "days_until_membership_expire", "account_age_days", "subscription_history_days", "observed_log_span_days"]


@query("p11_recency", BASE_SQL + f"\nSELECT msno, {', '.join(_RECENCY)} FROM base")
def p11_recency(spark, sf):
    return _base(spark, sf).select("msno", *_RECENCY)


@query("p12_deltas", rounded_sql(select(BASE_SQL, f"SELECT msno, {', '.join(DELTA_DOUBLES + RATIO_DOUBLES)} FROM base"), DELTA_DOUBLES + RATIO_DOUBLES))
def p12_deltas(spark, sf):
    return rounded(_base(spark, sf).select("msno", *DELTA_DOUBLES, *RATIO_DOUBLES), DELTA_DOUBLES + RATIO_DOUBLES)


_PRESENCE = ["membership_active_flag", "latest_cancel_flag", "latest_auto_renew_flag", "has_member_record", "has_transaction_record", "has_log_record"]


@query("p13_presence", BASE_SQL + f"\nSELECT msno, {', '.join(_PRESENCE)} FROM base")
def p13_presence(spark, sf):
    return _base(spark, sf).select("msno", *_PRESENCE)


CAPPED_SQL = BASE_SQL + ",\n" + caps_cte()


@query("p14_winsorise", rounded_sql(select(CAPPED_SQL, f"SELECT msno, {', '.join(CAPPED_DOUBLES)} FROM capped"), CAPPED_DOUBLES))
def p14_winsorise(spark, sf):
    base = materialise(_base(spark, sf).select("msno", *CAPPED_COLUMNS), "base")
    return rounded(add_capped_columns(base).select("msno", *CAPPED_DOUBLES), CAPPED_DOUBLES)


@query("p15_model_frame", rounded_sql(select(CAPPED_SQL,
    "SELECT * EXCLUDE (msno, registration_init_date, first_transaction_date, last_transaction_date, max_membership_expire_date, latest_transaction_date,"
    f" latest_membership_expire_date, first_log_date, last_log_date, latest_log_date, {', '.join(CAPPED_COLUMNS)}) FROM capped"),
    [c for c in BASE_DOUBLES + CAPPED_DOUBLES if c not in CAPPED_COLUMNS]))
def p15_model_frame(spark, sf):
    frame = sub.model_frame(add_capped_columns(materialise(_base(spark, sf), "base")))
    return rounded(frame, [c for c in BASE_DOUBLES + CAPPED_DOUBLES if c not in CAPPED_COLUMNS])


@query("p16_roles", "WITH " + cte("b_telco") + "\nSELECT customerID, coalesce(OnlineSecurity, '__missing__') AS OnlineSecurity, coalesce(PaymentMethod, '__missing__') AS PaymentMethod, tenure, MonthlyCharges FROM b_telco")
def p16_roles(spark, sf):
    df = bind(spark, sf, "b_telco")
    numeric, categorical = sub.column_roles(df, exclude=("customerID", "Churn"))
    filled = sub.fill_categories(df, categorical)
    shown = [c for c in ("OnlineSecurity", "PaymentMethod") if c in categorical] + [c for c in ("tenure", "MonthlyCharges") if c in numeric]
    return filled.select("customerID", *shown)


@query("p21_feature_contract", "WITH " + cte("b_telco") + "\nSELECT count(*) AS n, 19 AS features FROM b_telco")
def p21_feature_contract(spark, sf):
    df = bind(spark, sf, "b_telco")
    features = [c for c in df.columns if c not in ("customerID", "Churn")]
    validate_features(features, sorted(features))
    return df.agg(F.count("*").alias("n"), F.lit(len(features)).alias("features"))


@query("p22_id_column", "WITH " + cte("b_telco", "b_label") + "\nSELECT 'customerID' AS id_column, count(DISTINCT customerID) AS ids FROM b_telco UNION ALL SELECT 'msno', count(DISTINCT msno) FROM b_label")
def p22_id_column(spark, sf):
    def ids(binding, dataset):
        df = bind(spark, sf, binding)
        name = find_id_column(df.columns, dataset)
        return df.agg(F.lit(name).alias("id_column"), F.countDistinct(name).alias("ids"))
    return ids("b_telco", "telco").unionByName(ids("b_label", "subscription"))


# ---------------------------------------------------------------- aggregates, windows, joins


@query("a1_txn_features", rounded_sql(select(_TF, "SELECT * FROM t_features JOIN t_latest USING (msno)"), TXN_DOUBLES))
def a1_txn_features(spark, sf):
    return rounded(sub.transaction_features(_txn(spark, sf)), TXN_DOUBLES)


@query("a1_line_features", rounded_sql(select(
    "WITH " + cte("b_line_transactions") + ",\n" + ",\n".join([transactions_cte("b_line_transactions"), TXN_LINKED, TXN_FEATURES]), "SELECT * FROM t_features"), TXN_DOUBLES))
def a1_line_features(spark, sf):
    features = sub.transaction_features(_txn(spark, sf, "b_line_transactions"))
    return rounded(features.select(*[c for c in features.columns if not c.startswith("latest_")]), TXN_DOUBLES)


@query("a2_log_features", rounded_sql(select(_LS + ",\n" + LOG_FEATURES, "SELECT * FROM l_features"), LOG_DOUBLES))
def a2_log_features(spark, sf):
    features = sub.log_features(sub.add_daily_metrics(_logs(spark, sf)))
    return rounded(features.select(*[c for c in features.columns if not c.startswith("latest_")]), LOG_DOUBLES)


@query("a3_latest_log", rounded_sql(select(_LS + ",\n" + LOG_LATEST, "SELECT * FROM l_latest"), LATEST_DOUBLES))
def a3_latest_log(spark, sf):
    return rounded(sub.latest_logs(sub.add_daily_metrics(_logs(spark, sf))), LATEST_DOUBLES)


@query("a4_anchor", "WITH " + cte("b_transactions", "b_logs") + ",\n" + ",\n".join([transactions_cte(), LOGS, ANCHOR]) + "\nSELECT feature_anchor_date FROM anchor")
def a4_anchor(spark, sf):
    return sub.feature_anchor(_txn(spark, sf), _logs(spark, sf))


@query("a10_quantiles", rounded_sql(
    "SELECT quantile_cont(l_extendedprice, 0.01) AS p1, quantile_cont(l_extendedprice, 0.25) AS p25, quantile_cont(l_extendedprice, 0.5) AS p50,"
    " quantile_cont(l_extendedprice, 0.75) AS p75, quantile_cont(l_extendedprice, 0.99) AS p99 FROM lineitem", ["p1", "p25", "p50", "p75", "p99"]))
def a10_quantiles(spark, sf):
    names, probs = ["p1", "p25", "p50", "p75", "p99"], [0.01, 0.25, 0.5, 0.75, 0.99]
    q = exact_quantiles(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_extendedprice"], probs)
    return rounded(q.select(*[F.col("l_extendedprice")[i].alias(n) for i, n in enumerate(names)]), names)


@query("w1_latest_txn", _TF + "\nSELECT * FROM t_latest")
def w1_latest_txn(spark, sf):
    return sub.latest_transactions(_txn(spark, sf))


@query("w2_lag", _T + ",\n" + TXN_LINKED + "\nSELECT msno, transaction_date, membership_expire_date, prev_transaction_date, prev_expire_date FROM t_linked")
def w2_lag(spark, sf):
    return sub.with_previous_transaction(_txn(spark, sf)).select(
        "msno", "transaction_date", "membership_expire_date", "prev_transaction_date", "prev_expire_date")


@query("j1_base_features", rounded_sql(select(BASE_SQL, "SELECT * FROM base"), BASE_DOUBLES))
def j1_base_features(spark, sf):
    return rounded(_base(spark, sf), BASE_DOUBLES)


@query("j2_anchor_scalar", "WITH " + cte("b_label", "b_transactions", "b_logs") + ",\n" + ",\n".join([transactions_cte(), LOGS, ANCHOR]) + "\nSELECT msno, feature_anchor_date FROM b_label, anchor")
def j2_anchor_scalar(spark, sf):
    anchor = sub.feature_anchor(_txn(spark, sf), _logs(spark, sf))
    return sub.clean_labels(bind(spark, sf, "b_label")).select("msno", anchor.scalar().alias("feature_anchor_date"))
