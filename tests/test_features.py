import pytest
from pyspark.sql import functions as F

from tidemark.functions import decisions as d
from tidemark.functions.telco import engineer_telco
from tidemark.functions.themes import feature_theme
from tidemark.operators import subscription as sub

TELCO = [
    ("001", "Yes", 1, 70.0, "70.0", "Month-to-month", "Electronic check", "Yes", "Fiber optic", "No", "No", "No", "No"),
    ("002", "No", 24, 40.0, "960.0", "Two year", "Mailed check", "No", "DSL", "Yes", "Yes", "Yes", "Yes"),
]
TELCO_SCHEMA = (
    "customerID string, Churn string, tenure int, MonthlyCharges double, TotalCharges string, Contract string, PaymentMethod string,"
    " PaperlessBilling string, InternetService string, OnlineSecurity string, TechSupport string, StreamingTV string, StreamingMovies string"
)
EXPECTED = {
    "ChurnFlag": (1, 0), "avg_monthly_spend": (70, 40), "price_ratio": (1, 1), "revenue_risk_proxy": (70, 960), "tenure_group": ("0-1yr", "1-2yr"),
    "customer_stage": ("new", "established"), "is_month_to_month": (1, 0), "auto_pay": (0, 0), "electronic_check": (1, 0), "paperless": (1, 0),
    "num_services": (0, 4), "service_adoption_rate": (0, 1), "multi_service_customer": (0, 1), "has_support": (0, 1), "has_streaming": (0, 1),
    "fiber_customer": (1, 0), "fiber_monthly": (1, 0), "high_bill": (1, 0), "low_tenure_high_bill": (1, 0),
    "month_to_month_no_support": (1, 0), "high_value_long_tenure": (0, 0),
}


def test_telco_features(spark):
    a, b = engineer_telco(spark.createDataFrame(TELCO, TELCO_SCHEMA)).orderBy("customerID").collect()
    assert {k: (a[k], b[k]) for k in EXPECTED} == EXPECTED


def test_telco_emits_only_what_it_can(spark):
    out = engineer_telco(spark.createDataFrame([(5,)], "tenure int"))
    assert out.columns == ["tenure", "tenure_group", "customer_stage"]


def test_fitted_cutoffs_apply_to_one_row(spark):
    row = engineer_telco(spark.createDataFrame(TELCO[:1], TELCO_SCHEMA), (60.0, 50.0)).first()
    assert (row.high_bill, row.low_tenure_high_bill) == (1, 1)


@pytest.mark.parametrize("p, threshold, tier", [(0.8, 0.5, "High"), (0.7, 0.8, "Medium"), (0.66, 0.5, "High"), (0.4, 0.5, "Medium"), (0.1, 0.5, "Low"), (0.33, 0.5, "Medium")])
def test_batch_tier(spark, p, threshold, tier):
    assert spark.range(1).select(d.risk_tier(F.lit(p), "batch", threshold)).first()[0] == tier


def test_report_tier_edges(spark):
    got = [spark.range(1).select(d.risk_tier(F.lit(p), "report")).first()[0] for p in (0.0, 0.33, 0.34, 0.66, 0.67, 1.0, 1.5)]
    assert got == ["Low", "Low", "Medium", "Medium", "High", "High", None]


@pytest.mark.parametrize("p, threshold, words", [(0.9, 0.4, "Save offer"), (0.6, 0.5, "High-touch"), (0.4, 0.6, "Monitor"), (0.1, 0.4, "No intervention"), (0.58, 0.6, "Proactive")])
def test_action(spark, p, threshold, words):
    assert spark.range(1).select(d.recommended_action(F.lit(p), threshold)).first()[0].startswith(words)


def test_action_watches_high_value(spark):
    df = spark.createDataFrame([(0.1, 130.0), (0.1, 100.0), (0.1, None)], "p double, m double")
    got = [r[0] for r in df.select(d.recommended_action(F.col("p"), 0.5, F.col("m"))).collect()]
    assert [g.split()[0] for g in got] == ["Monitor", "No", "No"]


THEMES = {
    "total_secs_sum": "Engagement & Listening", "payment_plan_days": "Subscription & Billing", "membership_expire_date": "Renewal & Expiry",
    "MonthlyCharges": "Pricing & Value", "TechSupport": "Support & Protection", "Contract": "Billing & Contract", "login_count": "Engagement & Usage",
    "churn_probability": "Retention Risk", "customer_state": "Customer Profile", "unknown_feature": "Other", "MONTHLYCHARGES": "Pricing & Value",
    "paperlessbilling_flag": "Billing & Contract", "tenure_group_bucket": "Customer Lifecycle", "auto_renew_flag": "Subscription & Billing",
    "payment_method_credit": "Subscription & Billing", "latest_transaction_date": "Recency & Activity", "agent_channel": "Customer Profile",
    "monthly_revenue": "Pricing & Value",
}


def test_themes(spark):
    df = spark.createDataFrame([(n,) for n in THEMES], "name string")
    assert dict(df.select("name", feature_theme(F.col("name")).alias("t")).collect()) == THEMES


def test_cleaning_rules(spark):
    raw = spark.createDataFrame(
        [("a", "0", "25", " Male ", "7", "20160229"), ("b", "25", "-5", "", "x", "20160230"), ("c", "3.5", None, None, None, "2016022"), ("d", "1", "101", "FEMALE", "9", " 2016022")],
        "msno string, city string, bd string, gender string, registered_via string, registration_init_time string",
    )
    rows = {r.msno: r for r in sub.clean_members(raw).collect()}
    assert [rows[k].city for k in "abcd"] == [None, 25, None, 1]
    assert [rows[k].age for k in "abcd"] == [25, None, None, None]
    assert [rows[k].age_missing_or_invalid for k in "abcd"] == [0, 1, 1, 1]
    assert [(rows[k].gender_male, rows[k].gender_female, rows[k].gender_missing) for k in "abcd"] == [(1, 0, 0), (0, 0, 1), (0, 0, 1), (0, 1, 0)]
    assert [str(rows[k].registration_init_date) for k in "abcd"] == ["2016-02-29", "None", "None", "None"]
    assert sub.clean_members(raw, lenient=True).filter("msno = 'c'").first().city == 4


def test_unmatched_users_keep_their_row(spark):
    labels = spark.createDataFrame([("only_label", "0"), ("member", "1")], "msno string, is_churn string")
    members = spark.createDataFrame([("member", "1", "30", "male", "1", "20150101")], "msno string, city string, bd string, gender string, registered_via string, registration_init_time string")
    txn = spark.createDataFrame([], ", ".join(f"{c} string" for c in ("msno", "payment_method_id", "payment_plan_days", "plan_list_price", "actual_amount_paid", "is_auto_renew", "transaction_date", "membership_expire_date", "is_cancel")))
    logs = spark.createDataFrame([], ", ".join(f"{c} string" for c in ("msno", "date", "num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs")))
    out = sub.base_features(labels, members, txn, logs)
    assert len(out.columns) == 91
    rows = {r.msno: r for r in out.collect()}
    assert rows["only_label"].has_member_record == 0 and rows["member"].has_member_record == 1
    assert rows["member"].has_transaction_record == rows["member"].has_log_record == 0
    assert rows["member"].songs_played_std == 0 and rows["member"].txn_count is None
    assert rows["member"].account_age_days == -16436  # the anchor falls back to 1970-01-01
