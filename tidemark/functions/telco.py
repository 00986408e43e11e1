"""Telco customer features. Each is emitted only when its inputs are present."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import CUSTOMER_STAGES, SERVICE_COLUMNS, TENURE_GROUPS
from ..operators.quantiles import exact_quantiles
from .columns import flag, right_closed_bins


def fit_bill_cutoffs(df: DataFrame) -> DataFrame:
    """One row: the 75th percentile and the median of MonthlyCharges (exact, interpolated)."""
    q = exact_quantiles(df, ["MonthlyCharges"], [0.75, 0.5])
    return q.select(F.col("MonthlyCharges")[0].alias("p75"), F.col("MonthlyCharges")[1].alias("median"))


def _cutoffs(cutoffs) -> Column:
    """Cut-offs as a struct: from a fitted one-row frame, or from plain (p75, median) numbers."""
    if isinstance(cutoffs, DataFrame):
        return cutoffs.select(F.struct("p75", "median").alias("q")).scalar()
    p75, median = cutoffs
    return F.struct(F.lit(float(p75)).alias("p75"), F.lit(float(median)).alias("median"))


def engineer_telco(df: DataFrame, cutoffs=None) -> DataFrame:
    """Add the churn features.

    ``cutoffs`` holds the bill quantiles fitted on training rows (a one-row frame from
    ``fit_bill_cutoffs`` or a (p75, median) pair). Without it they are fitted on ``df``
    itself.
    """
    have = set(df.columns)
    c = F.col

    if "TotalCharges" in have:
        total = F.trim(c("TotalCharges").cast("string")).try_cast("double")
        if "MonthlyCharges" in have:
            total = F.coalesce(total, c("MonthlyCharges"))
        df = df.withColumn("TotalCharges", total)
    if "Churn" in have:
        df = df.withColumn("ChurnFlag", flag(F.lower("Churn") == "yes"))

    new: dict[str, Column] = {}
    yes = {name: flag(c(name) == "Yes") for name in SERVICE_COLUMNS if name in have}

    if {"TotalCharges", "tenure", "MonthlyCharges"} <= have:
        average = F.when(c("tenure") > 0, c("TotalCharges") / c("tenure")).otherwise(c("MonthlyCharges"))
        new["avg_monthly_spend"] = average
        new["price_ratio"] = F.when(average > 0, c("MonthlyCharges") / average).otherwise(1.0)
        new["revenue_risk_proxy"] = c("MonthlyCharges") * F.greatest(c("tenure"), F.lit(1))
    if "tenure" in have:
        new["tenure_group"] = right_closed_bins(c("tenure"), TENURE_GROUPS)
        new["customer_stage"] = right_closed_bins(c("tenure"), CUSTOMER_STAGES)

    monthly_contract = c("Contract") == "Month-to-month" if "Contract" in have else None
    if monthly_contract is not None:
        new["is_month_to_month"] = flag(monthly_contract)
    if "PaymentMethod" in have:
        new["auto_pay"] = flag(F.lower("PaymentMethod").contains("automatic"))
        new["electronic_check"] = flag(c("PaymentMethod") == "Electronic check")
    if "PaperlessBilling" in have:
        new["paperless"] = flag(c("PaperlessBilling") == "Yes")

    if yes:
        services = sum(yes.values(), F.lit(0))
        new["num_services"] = services
        new["service_adoption_rate"] = services / F.lit(float(len(yes)))
        new["multi_service_customer"] = flag(services >= 4)

    support = None
    if {"OnlineSecurity", "TechSupport"} <= have:
        support = F.greatest(yes["OnlineSecurity"], yes["TechSupport"])
        new["has_support"] = support
    if {"StreamingTV", "StreamingMovies"} <= have:
        new["has_streaming"] = F.greatest(yes["StreamingTV"], yes["StreamingMovies"])

    fiber = c("InternetService") == "Fiber optic" if "InternetService" in have else None
    if fiber is not None:
        new["fiber_customer"] = flag(fiber)
    if "SeniorCitizen" in have:
        new["senior_citizen"] = c("SeniorCitizen").cast("int")

    if "MonthlyCharges" in have:
        df = df.withColumn("_bill", _cutoffs(fit_bill_cutoffs(df) if cutoffs is None else cutoffs))
        bill, p75, median = c("MonthlyCharges"), c("_bill.p75"), c("_bill.median")
        new["high_bill"] = flag(bill > p75)
        if "tenure" in have:
            new["low_tenure_high_bill"] = flag((c("tenure") <= 12) & (bill > median))
            new["high_value_long_tenure"] = flag((bill > p75) & (c("tenure") > 24))

    if fiber is not None and monthly_contract is not None:
        new["fiber_monthly"] = flag(fiber & monthly_contract)
    if support is not None and monthly_contract is not None:
        new["month_to_month_no_support"] = flag(monthly_contract & (support == 0))

    return df.withColumns(new).drop("_bill") if new else df
