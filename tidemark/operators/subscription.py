"""Subscription features: raw text tables to one row per user.

Transactions are first folded to one row per user and day, so the later window holds at most one
row per calendar day for a user however many transactions that user has. Logs go through a single
groupBy whose buffers are all primitives: a hash aggregate with map-side combine, no sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..fixed_values import (
    AGE_RANGE, CAPPED_COLUMNS, CITY_RANGE, DAY_SECONDS_RANGE, MISSING_CATEGORY, PLAN_DAYS_RANGE,
    PLAY_COUNT_RANGE, PRICE_RANGE, RAW_DATE_COLUMNS,
)
from ..functions.columns import (
    compact_date, days_between, flag, number, ratio_or_zero, whole_number, within, zero_or_one,
)
from .ranking import with_previous

# ---------------------------------------------------------------- cleaning


def clean_labels(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("msno").cast("string").alias("msno"), F.col("is_churn").cast("int").alias("is_churn"))


def clean_members(raw: DataFrame, lenient: bool = False) -> DataFrame:
    city, age = whole_number(F.col("city"), lenient), whole_number(F.col("bd"), lenient)
    gender = F.lower(F.trim("gender"))
    return raw.select(
        F.col("msno").cast("string").alias("msno"),
        within(city, CITY_RANGE).alias("city"),
        within(age, AGE_RANGE).alias("age"),
        F.when(age.between(*AGE_RANGE), 0).otherwise(1).alias("age_missing_or_invalid"),
        flag(gender == "male").alias("gender_male"),
        flag(gender == "female").alias("gender_female"),
        F.when(gender != "", 0).otherwise(1).alias("gender_missing"),
        whole_number(F.col("registered_via"), lenient).alias("registered_via"),
        compact_date(F.col("registration_init_time")).alias("registration_init_date"),
    )


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Range-checked transactions; rows without a valid transaction date are dropped."""
    method = whole_number(F.col("payment_method_id"))
    return raw.select(
        F.col("msno").cast("string").alias("msno"),
        F.when(method >= 0, method).alias("payment_method_id"),
        within(number(F.col("payment_plan_days")), PLAN_DAYS_RANGE).alias("payment_plan_days"),
        within(number(F.col("plan_list_price")), PRICE_RANGE).alias("plan_list_price"),
        within(number(F.col("actual_amount_paid")), PRICE_RANGE).alias("actual_amount_paid"),
        zero_or_one(F.col("is_auto_renew")).alias("is_auto_renew"),
        compact_date(F.col("transaction_date")).alias("transaction_date"),
        compact_date(F.col("membership_expire_date")).alias("membership_expire_date"),
        zero_or_one(F.col("is_cancel")).alias("is_cancel"),
    ).filter(F.col("transaction_date").isNotNull())


PLAY_COUNTS = ["num_25", "num_50", "num_75", "num_985", "num_100", "num_unq"]


def clean_logs(raw: DataFrame) -> DataFrame:
    """Range-checked daily logs (out of range counts as 0); rows without a valid date are dropped."""
    return raw.select(
        F.col("msno").cast("string").alias("msno"),
        compact_date(F.col("date")).alias("log_date"),
        *[within(number(F.col(c)), PLAY_COUNT_RANGE, 0.0).alias(c) for c in PLAY_COUNTS],
        within(number(F.col("total_secs")), DAY_SECONDS_RANGE, 0.0).alias("total_secs"),
    ).filter(F.col("log_date").isNotNull())


# ---------------------------------------------------------------- daily listening metrics


def add_daily_metrics(logs: DataFrame, guarded: bool = True) -> DataFrame:
    """Songs played and its ratios per log row. Unguarded: a zero denominator gives NULL, not 0."""
    c = F.col
    ratio = ratio_or_zero if guarded else F.try_divide
    songs = c("songs_played")
    played = c("num_25") + c("num_50") + c("num_75") + c("num_985") + c("num_100")
    repeat = F.when(songs > 0, 1 - c("num_unq") / songs)
    return (
        logs.withColumn("songs_played", played)
        .withColumns({
            "completion_rate": ratio(c("num_100"), songs),
            "skip_rate": ratio(c("num_25"), songs),
            "near_completion_rate": ratio(c("num_985"), songs),
            "repeat_ratio": F.coalesce(repeat, F.lit(0.0)) if guarded else repeat,
            "avg_song_secs": ratio(c("total_secs"), songs),
            "secs_per_unique": ratio(c("total_secs"), c("num_unq")),
        })
        .withColumn(
            "quality_score",
            c("completion_rate") * 0.6 + c("near_completion_rate") * 0.3 - c("skip_rate") * 0.4,
        )
    )


# ---------------------------------------------------------------- transactions


_DAY_VALUES = [
    "payment_method_id", "payment_plan_days", "plan_list_price", "actual_amount_paid",
    "is_auto_renew", "is_cancel", "membership_expire_date",
]


def _transaction_order() -> Column:
    """A total order inside a day as one number: expiry, list price, amount paid, method, plan days, renewal, cancellation.

    Rows that are equal under it are equal, so the last one does not depend on the order of merging. One DECIMAL
    keeps ``max_by`` in the hash aggregate; a struct would force a sort. Prices count to four decimals, plan days as whole days, methods up to 2^30; NULL is lowest.
    """
    def code(value: Column, most: int) -> Column:
        return F.when(value.isNull(), 0).otherwise(F.least(value.cast("bigint") + 1, F.lit(most).cast("bigint")))

    prices = 1_000_000_002  # four decimals of up to 100,000, and NULL
    price = lambda name: code(F.col(name) * 10_000, prices - 1)
    expiry = F.coalesce(F.unix_date("membership_expire_date") + 1_000_000, F.lit(0)).cast("bigint")
    rest = (
        F.shiftleft(code(F.col("payment_method_id"), (1 << 30) - 1), 14) + F.shiftleft(code(F.col("payment_plan_days"), (1 << 12) - 1), 2)
        + F.shiftleft(F.coalesce(F.col("is_auto_renew").cast("bigint"), F.lit(0)), 1) + F.coalesce(F.col("is_cancel").cast("bigint"), F.lit(0))
    )  # 44 bits
    high = (expiry * prices + price("plan_list_price")).cast("decimal(16,0)")
    paid = price("actual_amount_paid").cast("decimal(10,0)")
    return ((high * F.lit(str(prices)).cast("decimal(10,0)") + paid) * F.lit(str(1 << 44)).cast("decimal(14,0)") + rest.cast("decimal(14,0)")).cast("decimal(38,0)")


def fold_transaction_days(transactions: DataFrame) -> DataFrame:
    """One row per user and day: sums that add up across days, plus the day's last row.

    Inside a day every row but the last is the predecessor of another row of that day, so the
    totals over predecessors are the totals over all rows less the last row's share.
    """
    c = F.col
    day, expiry = c("transaction_date"), c("membership_expire_date")
    keyed = transactions.withColumn("_order", _transaction_order())
    return keyed.groupBy("msno", "transaction_date").agg(
        F.count("*").alias("n"),
        F.max(expiry).alias("max_expiry"),
        F.sum("payment_plan_days").alias("plan_days_sum"),
        F.count("payment_plan_days").alias("plan_days_n"),
        F.max("payment_plan_days").alias("plan_days_max"),
        F.sum("plan_list_price").alias("list_sum"),
        F.sum("actual_amount_paid").alias("paid_sum"),
        F.count("actual_amount_paid").alias("paid_n"),
        F.max("actual_amount_paid").alias("paid_max"),
        F.sum("is_auto_renew").alias("renew_sum"),
        F.sum("is_cancel").alias("cancel_sum"),
        F.sum(F.when(c("plan_list_price") > 0, c("actual_amount_paid") / c("plan_list_price"))).alias("ratio_sum"),
        F.count(F.when(c("plan_list_price") > 0, c("actual_amount_paid"))).alias("ratio_n"),
        F.count(expiry).alias("gap_n"),
        F.sum(days_between(expiry, day)).alias("gap_sum"),
        F.count_if(day > expiry).alias("late_n"),
        F.count_if(day <= expiry).alias("early_n"),
        *[F.max_by(name, "_order").alias(f"last_{name}") for name in _DAY_VALUES],
    )


def _with_previous_day(days: DataFrame) -> DataFrame:
    # At most one row per calendar day and user in this window.
    by_day = Window.partitionBy("msno").orderBy("transaction_date")
    return days.withColumns({
        "previous_expiry": F.lag("last_membership_expire_date").over(by_day),
    })


def transaction_features(transactions: DataFrame) -> DataFrame:
    """Per user: the transaction aggregates and the latest transaction, one row each."""
    c = F.col
    day = c("transaction_date")
    last_expiry, previous_expiry = c("last_membership_expire_date"), c("previous_expiry")
    days = _with_previous_day(fold_transaction_days(transactions))

    def over_predecessors(total: str, share) -> Column:
        """All rows of the day as predecessors, less its last row, plus the previous day's last."""
        zero = F.lit(0).cast("bigint")
        return (
            F.coalesce(c(total), zero)
            - F.coalesce(share(last_expiry), zero)
            + F.coalesce(share(previous_expiry), zero)
        )

    linked = days.withColumns({
        "gap_n": over_predecessors("gap_n", lambda expiry: flag(expiry.isNotNull())),
        "gap_sum": over_predecessors("gap_sum", lambda expiry: days_between(expiry, day)),
        "late_n": over_predecessors("late_n", lambda expiry: flag(day > expiry)),
        "early_n": over_predecessors("early_n", lambda expiry: flag(day <= expiry)),
    })

    n = F.sum("n")
    first, last = F.min(day), F.max(day)
    return linked.groupBy("msno").agg(
        n.alias("txn_count"),
        first.alias("first_transaction_date"),
        last.alias("last_transaction_date"),
        F.max("max_expiry").alias("max_membership_expire_date"),
        F.try_divide(F.sum("plan_days_sum"), F.sum("plan_days_n")).alias("avg_payment_plan_days"),
        F.max("plan_days_max").alias("max_payment_plan_days"),
        F.sum("list_sum").alias("total_list_price"),
        F.sum("paid_sum").alias("total_amount_paid"),
        F.try_divide(F.sum("paid_sum"), F.sum("paid_n")).alias("avg_amount_paid"),
        F.max("paid_max").alias("max_amount_paid"),
        (F.sum("renew_sum") / n).alias("auto_renew_rate"),
        (F.sum("cancel_sum") / n).alias("cancel_rate"),
        F.sum("cancel_sum").alias("cancel_count"),
        F.try_divide(F.sum("ratio_sum"), F.sum("ratio_n")).alias("avg_paid_to_list_ratio"),
        # The gaps between consecutive transactions add up to the whole span.
        F.try_divide(days_between(first, last), n - 1).alias("avg_days_between_transactions"),
        F.try_divide(F.sum("gap_sum"), F.sum("gap_n")).alias("avg_gap_from_prev_expire_to_txn"),
        F.sum("late_n").alias("post_expiry_renewal_count"),
        F.sum("early_n").alias("early_renewal_count"),
        *[F.max_by(f"last_{name}", day).alias(f"latest_{name}") for name in _DAY_VALUES],
        last.alias("latest_transaction_date"),
    )


def latest_transactions(transactions: DataFrame) -> DataFrame:
    """The latest transaction of each user (last day, then latest expiry, then the tie-break)."""
    days = fold_transaction_days(transactions)
    return days.groupBy("msno").agg(
        *[F.max_by(f"last_{name}", "transaction_date").alias(f"latest_{name}") for name in _DAY_VALUES],
        F.max("transaction_date").alias("latest_transaction_date"),
    )


def with_previous_transaction(transactions: DataFrame) -> DataFrame:
    """Each transaction with the date and expiry of the one before it for the same user."""
    ordered = transactions.withColumn("_order", _transaction_order())
    return with_previous(
        ordered, ["msno"], [F.col("transaction_date").asc(), F.col("_order").asc()],
        {"prev_transaction_date": "transaction_date", "prev_expire_date": "membership_expire_date"},
    ).drop("_order")


# ---------------------------------------------------------------- logs

_LATEST_LOG_VALUES = [
    "songs_played", "total_secs", "num_unq", "completion_rate", "skip_rate", "near_completion_rate",
    "repeat_ratio", "avg_song_secs", "secs_per_unique", "quality_score",
]


def _log_order() -> Column:
    """Log date in the high bits, a row hash below it: a total order in one BIGINT."""
    row_hash = F.shiftrightunsigned(F.xxhash64(*PLAY_COUNTS, "total_secs"), 28)
    return F.shiftleft(F.unix_date("log_date").cast("bigint"), 36) + row_hash


def _latest_log_aggregates() -> list[Column]:
    return [F.max_by(name, "_order").alias(f"latest_{name}") for name in _LATEST_LOG_VALUES]


def latest_logs(scored: DataFrame) -> DataFrame:
    """The latest scored log row of each user."""
    return scored.withColumn("_order", _log_order()).groupBy("msno").agg(
        F.max("log_date").alias("latest_log_date"), *_latest_log_aggregates()
    )


def log_features(scored: DataFrame) -> DataFrame:
    """Per user: the log aggregates and the latest log row, in one pass and one exchange."""
    stats = {
        "songs_played": ("sum", "avg", "std"),
        "total_secs": ("sum", "avg", "std"),
        "num_unq": ("sum", "avg"),
        "completion_rate": ("avg", "std"),
        "skip_rate": ("avg", "std"),
        "near_completion_rate": ("avg",),
        "repeat_ratio": ("avg",),
        "avg_song_secs": ("avg",),
        "secs_per_unique": ("avg",),
        "quality_score": ("avg",),
    }
    functions = {"sum": F.sum, "avg": F.avg, "std": F.stddev_samp}
    return scored.withColumn("_order", _log_order()).groupBy("msno").agg(
        F.count("*").alias("log_day_count"),
        F.min("log_date").alias("first_log_date"),
        F.max("log_date").alias("last_log_date"),
        *[functions[s](name).alias(f"{name}_{s}") for name, kinds in stats.items() for s in kinds],
        F.max("total_secs").alias("max_total_secs_day"),
        F.max("songs_played").alias("max_songs_played_day"),
        F.max("log_date").alias("latest_log_date"),
        *_latest_log_aggregates(),
    )


# ---------------------------------------------------------------- anchor and assembly


def feature_anchor(transactions: DataFrame, logs: DataFrame, transaction_date: str = "transaction_date", log_date: str = "log_date") -> DataFrame:
    """One row: the latest date seen in either table, 1970-01-01 when both are empty."""
    epoch = F.to_date(F.lit("1970-01-01"))
    latest_txn = transactions.agg(F.max(transaction_date)).scalar()
    latest_log = logs.agg(F.max(log_date)).scalar()
    return transactions.sparkSession.range(1).select(
        F.greatest(F.coalesce(latest_log, epoch), F.coalesce(latest_txn, epoch)).alias("feature_anchor_date")
    )


def recency_columns(anchor: Column) -> dict[str, Column]:
    c = F.col
    return {
        "days_since_last_log": days_between(c("last_log_date"), anchor),
        "days_since_last_transaction": days_between(c("last_transaction_date"), anchor),
        "days_until_membership_expire": days_between(anchor, c("max_membership_expire_date")),
        "account_age_days": days_between(c("registration_init_date"), anchor),
        "subscription_history_days": days_between(c("first_transaction_date"), c("last_transaction_date")),
        "observed_log_span_days": days_between(c("first_log_date"), c("last_log_date")) + 1,
    }


def latest_versus_average_columns() -> dict[str, Column]:
    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    deltas = {
        "latest_vs_avg_total_secs_delta": "total_secs",
        "latest_vs_avg_songs_delta": "songs_played",
        "latest_vs_avg_completion_delta": "completion_rate",
        "latest_vs_avg_skip_delta": "skip_rate",
        "latest_vs_avg_quality_delta": "quality_score",
    }
    ratios = {
        "latest_to_avg_songs_ratio": ("latest_songs_played", "songs_played_avg"),
        "latest_to_avg_total_secs_ratio": ("latest_total_secs", "total_secs_avg"),
        "amount_paid_per_txn": ("total_amount_paid", "txn_count"),
        "avg_total_secs_per_logged_day": ("total_secs_sum", "log_day_count"),
        "avg_songs_per_logged_day": ("songs_played_sum", "log_day_count"),
    }
    return {
        **{k: or_zero(f"latest_{v}") - or_zero(f"{v}_avg") for k, v in deltas.items()},
        **{k: ratio_or_zero(F.col(a), F.col(b)) for k, (a, b) in ratios.items()},
    }


def status_columns(anchor: Column) -> dict[str, Column]:
    c = F.col
    return {
        "membership_active_flag": flag(c("max_membership_expire_date") >= anchor),
        "latest_cancel_flag": flag(c("latest_is_cancel") == 1),
        "latest_auto_renew_flag": flag(c("latest_is_auto_renew") == 1),
        "has_member_record": flag(c("_member").isNotNull()),
        "has_transaction_record": flag(c("txn_count").isNotNull()),
        "has_log_record": flag(c("log_day_count").isNotNull()),
    }


def assemble_features(labels: DataFrame, members: DataFrame, transactions: DataFrame, logs: DataFrame, anchor: DataFrame) -> DataFrame:
    """Labels left-joined with members, transaction features and log features on the user key.

    The feature frames already sit hash-partitioned by user, so Spark exchanges only the labels
    and members; the one-row anchor comes in as a scalar subquery.
    """
    day = F.col("_anchor")
    joined = (
        labels.join(members.withColumn("_member", F.lit(1)), "msno", "left")
        .join(transactions, "msno", "left")
        .join(logs, "msno", "left")
    )
    stds = [c for c in logs.columns if c.endswith("_std")]
    return (
        joined.withColumn("_anchor", anchor.select("feature_anchor_date").scalar())
        .withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in stds})
        .withColumns({**recency_columns(day), **latest_versus_average_columns(), **status_columns(day)})
        .drop("_member", "_anchor")
    )


def base_features(raw_labels: DataFrame, raw_members: DataFrame, raw_transactions: DataFrame, raw_logs: DataFrame) -> DataFrame:
    """Raw text tables to the 91-column base feature table, as one lazy plan."""
    transactions = transaction_features(clean_transactions(raw_transactions))
    logs = log_features(add_daily_metrics(clean_logs(raw_logs)))
    # The anchor comes from the per-user frames, whose exchanges Spark reuses: each fact table is read once.
    anchor = feature_anchor(transactions, logs, "last_transaction_date", "last_log_date")
    return assemble_features(clean_labels(raw_labels), clean_members(raw_members), transactions, logs, anchor)


# ---------------------------------------------------------------- model frame


def model_frame(df: DataFrame, target: str = "is_churn", id_col: str = "msno") -> DataFrame:
    """Drop id, raw dates and every raw column that has a capped twin; the target stays, last."""
    if target not in df.columns:
        raise ValueError(f"target column '{target}' is missing")
    twins = [c for c in CAPPED_COLUMNS if f"{c}_capped" in df.columns]
    kept = df.drop(id_col, *RAW_DATE_COLUMNS, *twins)
    return kept.select(*[c for c in kept.columns if c != target], F.col(target).cast("int").alias(target))


def column_roles(df: DataFrame, exclude: tuple = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names by type; booleans count as categorical."""
    numeric_types = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    numeric, categorical = [], []
    for name, dtype in df.dtypes:
        if name not in exclude:
            (numeric if dtype.startswith(numeric_types) else categorical).append(name)
    return numeric, categorical


def fill_categories(df: DataFrame, categorical: list[str]) -> DataFrame:
    """Categorical columns as text with NULL as its own category."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)) for c in categorical})
