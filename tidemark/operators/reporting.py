"""Business roll-ups over scored customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import TOP_RISK_COLUMNS, VALUE_COLUMN_CANDIDATES
from ..functions.decisions import risk_tier
from ..functions.themes import feature_theme


def value_column(columns: list[str]) -> str | None:
    return next((c for c in VALUE_COLUMN_CANDIDATES if c in columns), None)


def business_kpis(scored: DataFrame, threshold: float, p: str = "churn_probability") -> DataFrame:
    """One row: high-risk count and rate, revenue at risk, portfolio loss, mean high-risk value."""
    prob, high = F.col(p), F.col(p) >= threshold
    name = value_column(scored.columns)
    value = F.col(name).cast("double") if name else F.lit(None).cast("double")
    floored = F.greatest(F.coalesce(value, F.lit(0.0)), F.lit(0.0))
    zero = F.lit(0.0)
    return scored.agg(
        F.count_if(high).alias("high_risk_count"),
        F.coalesce(F.try_divide(F.count_if(high), F.count("*")), zero).alias("high_risk_rate"),
        F.coalesce(F.sum(F.when(high, prob * floored)), zero).alias("revenue_at_risk"),
        F.coalesce(F.sum(prob * floored), zero).alias("expected_loss_total"),
        F.coalesce(F.avg(F.when(high, value)), zero).alias("avg_value_high_risk"),
    )


def high_risk_counts(scored: DataFrame, by: str, threshold: float, name: str | None = None, p: str = "churn_probability") -> DataFrame:
    """Customers per value of ``by`` among the high-risk ones, NULL included, largest first."""
    name = name or by
    return (
        scored.filter(F.col(p) >= threshold)
        .groupBy(F.col(by).alias(name))
        .agg(F.count("*").alias("customer_count"))
        .orderBy(F.desc("customer_count"), F.asc(name))
    )


def action_counts(scored: DataFrame, threshold: float) -> DataFrame:
    return high_risk_counts(scored, "recommended_action", threshold)


def theme_rollup(importance: DataFrame) -> DataFrame:
    """Mean absolute attributions summed by theme, largest first."""
    return (
        importance.groupBy(feature_theme(F.col("feature")).alias("driver_theme"))
        .agg(F.sum("mean_abs_shap").alias("importance"))
        .orderBy(F.desc("importance"), F.asc("driver_theme"))
    )


def theme_counts(scored: DataFrame, threshold: float, importance: DataFrame | None = None) -> DataFrame:
    """Driver themes among high-risk customers; the global roll-up when rows carry none."""
    if "primary_driver_theme" in scored.columns:
        counts = high_risk_counts(scored, "primary_driver_theme", threshold, "driver_theme")
        if importance is None or not counts.isEmpty():
            return counts
    if importance is None:
        return scored.sparkSession.createDataFrame([], "driver_theme string, customer_count bigint")
    return theme_rollup(importance)


def tier_distribution(scored: DataFrame, p: str = "churn_probability") -> DataFrame:
    """Customers per risk tier; without a tier column the reporting bins are used."""
    tier = F.col("risk_tier") if "risk_tier" in scored.columns else risk_tier(F.col(p), "report")
    return scored.groupBy(tier.alias("risk_tier")).agg(F.count("*").alias("customer_count"))


def technical_summary(metrics: DataFrame, threshold: float | None = None) -> DataFrame:
    """The headline test metrics of a one-row metrics frame, 0 (threshold: 0.5) when absent."""
    def known(name: str, default: float) -> Column:
        return F.coalesce(F.col(name), F.lit(default)) if name in metrics.columns else F.lit(default)

    return metrics.select(
        *[known(m, 0.0).alias(m) for m in ("roc_auc", "pr_auc", "f1", "precision", "recall")],
        (F.lit(float(threshold)) if threshold is not None else known("threshold", 0.5)).alias("threshold"),
    )


def evaluation_snapshot(scored: DataFrame, threshold: float, p: str = "churn_probability", charge: str = "MonthlyCharges") -> DataFrame:
    at_risk = F.sum(F.col(p) * F.col(charge)) if charge in scored.columns else F.lit(0.0)
    return scored.agg(
        F.count("*").alias("customers_scored"),
        F.count_if(F.col(p) >= threshold).alias("predicted_high_risk"),
        F.coalesce(at_risk, F.lit(0.0)).alias("monthly_revenue_at_risk"),
    )


def revenue_at_risk(scored: DataFrame, p: str = "churn_probability", charge: str = "MonthlyCharges") -> DataFrame:
    return scored.agg(F.sum(F.col(p) * F.col(charge)).alias("revenue_at_risk"))


def mean_probability(scored: DataFrame, p: str = "churn_probability") -> DataFrame:
    return scored.agg(F.avg(p).alias("mean_churn_probability"))


def top_risk_customers(scored: DataFrame, n: int = 25, tie_break: str = "customerID", p: str = "churn_probability") -> DataFrame:
    """The n riskiest customers with the report columns that are present."""
    columns = [c for c in TOP_RISK_COLUMNS if c in scored.columns]
    return scored.orderBy(F.col(p).desc_nulls_last(), F.asc(tie_break)).select(*columns).limit(n)


# ---------------------------------------------------------------- insight sentences


def _whole(c: Column) -> Column:
    return F.format_number(c, 0)


def business_insights(kpis: DataFrame, themes: DataFrame) -> DataFrame:
    """The five report sentences, numbered, from the KPI row and the theme counts."""
    size = [c for c in themes.columns if c != "driver_theme"][0]
    top = themes.orderBy(F.desc(size), F.asc("driver_theme")).limit(1).select("driver_theme").scalar()
    c = F.col
    sentences = [
        F.concat(c("high_risk_count").cast("string"), F.lit(" customers are above the current intervention threshold.")),
        F.concat(F.lit("Estimated near-term revenue at risk (high-risk only): $"), _whole(c("revenue_at_risk")), F.lit(".")),
        F.concat(F.lit("Portfolio-wide expected churn loss: $"), _whole(c("expected_loss_total")), F.lit(" per month.")),
        F.concat(F.lit("Average value of a high-risk customer: $"), _whole(c("avg_value_high_risk")), F.lit(".")),
        F.concat(F.lit("The most common driver theme among high-risk customers is "), F.coalesce(top, F.lit("N/A")), F.lit(".")),
    ]
    return kpis.select(F.posexplode(F.array(*sentences)).alias("line", "insight"))


def causal_insights(summary: DataFrame, policy: DataFrame) -> DataFrame:
    """Sentences on the average effect, the top bin and the policy's expected net gain."""
    gain = policy.agg(F.coalesce(F.sum("expected_gain"), F.lit(0.0))).scalar()
    ate, top, budget = F.col("ate"), F.col("uplift_top_bin"), F.col("budget_fraction")
    direction = F.when(ate < 0, "reduced").otherwise("increased")
    sentences = [
        F.concat(F.lit("Treatment "), direction, F.lit(" churn by "), F.format_number(F.abs(ate * 100), 1), F.lit(" pts on average.")),
        F.concat(F.lit("Top uplift bin shows "), F.format_string("%.1f", top * 100), F.lit(" pt lift; focus top "),
                 F.format_string("%.0f", budget * 100), F.lit("% customers.")),
        F.concat(F.lit("Expected net gain from policy: "), F.format_number(gain, 1), F.lit(" value units.")),
    ]
    return summary.select(F.posexplode(F.array(*sentences)).alias("line", "insight"))


def causal_view(summary: DataFrame, policy: DataFrame) -> DataFrame:
    """The causal summary row with the policy's total expected gain."""
    gain = policy.agg(F.coalesce(F.sum("expected_gain"), F.lit(0.0))).scalar()
    return summary.withColumn("total_expected_gain", gain)
