"""Names, texts and cut-offs that results depend on."""

# --- raw table layouts (every column arrives as text) -------------------------
LABEL_COLUMNS = ["msno", "is_churn"]
MEMBER_COLUMNS = ["msno", "city", "bd", "gender", "registered_via", "registration_init_time"]
TRANSACTION_COLUMNS = [
    "msno", "payment_method_id", "payment_plan_days", "plan_list_price", "actual_amount_paid",
    "is_auto_renew", "transaction_date", "membership_expire_date", "is_cancel",
]
LOG_COLUMNS = [
    "msno", "date", "num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs",
]

# --- valid ranges of raw values -----------------------------------------------
CITY_RANGE = (1, 25)
AGE_RANGE = (10, 100)
PLAN_DAYS_RANGE = (0, 3650)
PRICE_RANGE = (0, 100000)
PLAY_COUNT_RANGE = (0, 100000)
DAY_SECONDS_RANGE = (0, 86400)

# --- winsorised columns and date columns of the subscription feature table ----
CAPPED_COLUMNS = [
    "total_secs_sum", "total_secs_avg", "songs_played_sum", "songs_played_avg", "num_unq_sum",
    "avg_amount_paid", "total_amount_paid", "avg_payment_plan_days", "days_since_last_log",
    "days_since_last_transaction", "days_until_membership_expire", "account_age_days",
    "latest_to_avg_total_secs_ratio", "latest_to_avg_songs_ratio",
    "latest_vs_avg_total_secs_delta", "latest_vs_avg_songs_delta",
]
CAP_PROBABILITIES = (0.01, 0.99)
RAW_DATE_COLUMNS = [
    "registration_init_date", "first_transaction_date", "last_transaction_date",
    "max_membership_expire_date", "latest_transaction_date", "latest_membership_expire_date",
    "first_log_date", "last_log_date", "latest_log_date",
]
MISSING_CATEGORY = "__missing__"

# --- telco features -------------------------------------------------------------
SERVICE_COLUMNS = [
    "PhoneService", "MultipleLines", "OnlineSecurity", "OnlineBackup",
    "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
]
TENURE_GROUPS = [(0, "new"), (12, "0-1yr"), (24, "1-2yr"), (48, "2-4yr"), (72, "4-6yr")]
CUSTOMER_STAGES = [(6, "new"), (24, "established"), (60, "loyal"), (None, "long_term")]

# --- decisions --------------------------------------------------------------------
ACTION_SAVE = "Save offer: retention specialist call + bill credit"
ACTION_OUTREACH = "High-touch outreach: contract renewal or loyalty perks"
ACTION_NUDGE = "Proactive nudge: speed/bundle upgrade email"
ACTION_MONITOR = "Monitor + CSAT survey follow-up"
ACTION_NONE = "No intervention needed"
HIGH_VALUE_CHARGE = 120
VALUE_COLUMN_CANDIDATES = [
    "estimated_monthly_value", "MonthlyCharges", "avg_amount_paid",
    "latest_actual_amount_paid", "amount_paid_per_txn",
]
TOP_RISK_COLUMNS = [
    "customerID", "churn_probability", "risk_tier", "recommended_action", "primary_driver_theme",
    "top_driver_1", "top_driver_2", "top_driver_3", "MonthlyCharges", "tenure", "Contract",
]

# --- evaluation -------------------------------------------------------------------
SAVED_SPLIT_PATHS = [
    "splits/test_ids.parquet", "splits/test_ids.csv", "splits/test_rows.parquet",
    "splits/test_rows.csv", "splits/test_indices.parquet", "splits/test_indices.csv",
    "test_set.parquet", "test_set.csv",
]
SPLIT_INDICATOR_COLUMNS = ["split", "partition", "dataset"]
SAVED_ID_COLUMNS = ["row_id", "index", "idx", "id"]
SAVED_TARGET_COLUMNS = ["target", "label", "y"]
ID_COLUMNS = ["customerID", "customer_id", "id", "ID"]
SUBSCRIPTION_ID_COLUMNS = ["msno", "member_id", "user_id"]
SCORE_COLUMN_CANDIDATES = ["uplift_score", "priority_score", "churn_probability"]

# --- feature themes: first theme with a keyword inside the feature name wins --------
THEME_KEYWORDS = [
    ("Engagement & Listening",
     ["songs_played", "total_secs", "completion_rate", "skip_rate", "near_completion",
      "quality_score", "repeat_ratio", "log_day", "secs_per_unique", "avg_song"]),
    ("Subscription & Billing",
     ["payment_plan", "plan_list_price", "actual_amount_paid", "amount_paid", "payment_method",
      "auto_renew", "paid_to_list", "amount_paid_per_txn", "cancel"]),
    ("Renewal & Expiry",
     ["membership_expire", "post_expiry", "early_renewal", "latest_cancel", "latest_auto_renew"]),
    ("Recency & Activity",
     ["days_since_last", "latest_log", "latest_transaction", "last_log_date",
      "last_transaction_date"]),
    ("Content Breadth", ["num_unq", "secs_per_unique"]),
    ("Billing & Contract",
     ["contract", "paperless", "payment", "month_to_month", "electronic_check", "auto_pay"]),
    ("Customer Lifecycle",
     ["tenure", "customer_stage", "tenure_group", "months_since", "weeks_since"]),
    ("Pricing & Value",
     ["monthlycharges", "totalcharges", "avg_monthly_spend", "price_ratio", "high_bill",
      "revenue"]),
    ("Support & Protection",
     ["techsupport", "onlinesecurity", "onlinebackup", "deviceprotection", "support"]),
    ("Product Usage",
     ["internetservice", "fiber", "streaming", "phoneservice", "multipleservices",
      "num_services", "service"]),
    ("Engagement & Usage", ["login", "activity", "session", "crm", "usage", "adoption"]),
    ("Production", ["policy", "premium", "written", "submitted", "sold", "quote"]),
    ("Retention Risk", ["churn", "lapse", "drop", "inactive", "decline"]),
    ("Customer Profile",
     ["state", "channel", "agent", "segment", "type", "city", "age", "gender", "registered_via",
      "registration_init", "account_age", "senior", "partner", "dependents"]),
]
THEME_OTHER = "Other"

# Search ranges by model: (kind, low, high)
SEARCH_SPACE = {
    "boosted_shallow": {
        "n_estimators": ("int", 100, 800), "max_depth": ("int", 3, 10), "learning_rate": ("log", 0.01, 0.3),
        "subsample": ("float", 0.6, 1.0), "colsample_bytree": ("float", 0.6, 1.0),
        "min_child_weight": ("int", 1, 12), "gamma": ("float", 0.0, 5.0),
    },
    "boosted_leafy": {
        "n_estimators": ("int", 100, 800), "max_depth": ("int", -1, 12), "num_leaves": ("int", 16, 128),
        "learning_rate": ("log", 0.01, 0.3), "subsample": ("float", 0.6, 1.0),
        "colsample_bytree": ("float", 0.6, 1.0), "min_child_samples": ("int", 10, 100),
    },
}
