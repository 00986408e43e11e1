"""Score-to-decision columns: tiers, actions, customer value, revenue at risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import (
    ACTION_MONITOR, ACTION_NONE, ACTION_NUDGE, ACTION_OUTREACH, ACTION_SAVE, HIGH_VALUE_CHARGE,
)


def predicted_flag(p: Column, threshold: float) -> Column:
    return (p >= threshold).cast("int")


def risk_tier(p: Column, preset: str = "batch", threshold: float = 0.5) -> Column:
    """Risk tier under one of three presets.

    batch: High from max(threshold, 0.66), Medium from 0.33, else Low.
    service: low below 0.30, medium below 0.60, else high.
    report: right-closed bins [0, .33] Low, (.33, .66] Medium, (.66, 1] High, else NULL.
    """
    if preset == "batch":
        return F.when(p >= max(threshold, 0.66), "High").when(p >= 0.33, "Medium").otherwise("Low")
    if preset == "service":
        return F.when(p < 0.30, "low").when(p < 0.60, "medium").otherwise("high")
    if preset == "report":
        return (
            F.when((p < 0) | (p > 1), F.lit(None).cast("string"))
            .when(p <= 0.33, "Low").when(p <= 0.66, "Medium").when(p <= 1, "High")
        )
    raise ValueError(f"unknown tier preset: {preset}")


def recommended_action(p: Column, threshold: float, charges: Column | None = None) -> Column:
    """Five action levels; with ``charges``, low-risk customers of high value are watched too."""
    ladder = (
        F.when(p >= max(threshold + 0.15, 0.80), ACTION_SAVE)
        .when(p >= threshold, ACTION_OUTREACH)
        .when(p >= 0.55, ACTION_NUDGE)
        .when(p >= 0.33, ACTION_MONITOR)
    )
    if charges is not None:
        ladder = ladder.when(charges >= HIGH_VALUE_CHARGE, ACTION_MONITOR)
    return ladder.otherwise(ACTION_NONE)


def monthly_value(columns: list[str], dataset: str) -> Column:
    """Monthly revenue per customer from whichever source columns are present."""
    have = set(columns)
    choices: list[Column] = []
    if dataset == "telco":
        if "MonthlyCharges" in have:
            choices.append(F.col("MonthlyCharges").cast("double"))
        if {"TotalCharges", "tenure"} <= have:
            total = F.trim(F.col("TotalCharges").cast("string")).try_cast("double")
            choices.append(F.try_divide(total, F.col("tenure").cast("double")))
    else:
        if {"latest_actual_amount_paid", "latest_payment_plan_days"} <= have:
            days = F.col("latest_payment_plan_days")
            choices.append(F.when(days > 0, F.col("latest_actual_amount_paid") * 30.0 / days))
        for name in ("avg_amount_paid", "amount_paid_per_txn", "total_amount_paid"):
            if name in have:
                choices.append(F.col(name).cast("double"))
    return F.coalesce(*choices, F.lit(0.0))


def add_decisions(df: DataFrame, threshold: float, dataset: str, p: str = "churn_probability") -> DataFrame:
    """Turn scored rows into the batch output: flag, tier, action, stamps, value, revenue."""
    prob = F.col(p)
    value = monthly_value(df.columns, dataset)
    return df.withColumns({
        "predicted_churn": predicted_flag(prob, threshold),
        "risk_tier": risk_tier(prob, "batch", threshold),
        "recommended_action": recommended_action(prob, threshold),
        "model_threshold": F.lit(float(threshold)),
        "scored_at": F.current_timestamp(),
        "estimated_monthly_value": value,
        "expected_revenue_at_risk": prob * value,
    })
