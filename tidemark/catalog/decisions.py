"""Decisions per scored customer and their business roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import THEME_KEYWORDS
from ..functions import decisions as d
from ..functions.themes import feature_theme
from ..operators import reporting as r
from ..operators.explain import driver_columns, top_contributions
from ..operators.subscription import clean_transactions, transaction_features
from .bindings import bind, cte
from .registry import query, rounded, rounded_sql
from .subscription import TXN_FEATURES, TXN_LATEST, TXN_LINKED, transactions_cte

_S = "WITH " + cte("b_scored")
_T = "0.5::DOUBLE"
_BATCH_TIER = "CASE WHEN p >= greatest(0.5, 0.66) THEN 'High' WHEN p >= 0.33 THEN 'Medium' ELSE 'Low' END"
_LEVELS = (
    "WHEN p >= greatest(0.5 + 0.15, 0.80) THEN 'Save offer: retention specialist call + bill credit'"
    " WHEN p >= 0.5 THEN 'High-touch outreach: contract renewal or loyalty perks'"
    " WHEN p >= 0.55 THEN 'Proactive nudge: speed/bundle upgrade email' WHEN p >= 0.33 THEN 'Monitor + CSAT survey follow-up'"
)
_ACTION = f"CASE {_LEVELS} ELSE 'No intervention needed' END"


def _s(spark, sf):
    return bind(spark, sf, "b_scored")


@query("p23_predicted_flag", _S + "\nSELECT id, CAST(p >= 0.3 AS INT) AS predicted FROM b_scored")
def p23_predicted_flag(spark, sf):
    return _s(spark, sf).select("id", d.predicted_flag(F.col("p"), 0.3).alias("predicted"))


@query("d1_tier", _S + f"\nSELECT id, {_BATCH_TIER} AS tier FROM b_scored")
def d1_tier(spark, sf):
    return _s(spark, sf).select("id", d.risk_tier(F.col("p"), "batch", 0.5).alias("tier"))


@query("d2_tier_service", _S + "\nSELECT id, CASE WHEN p < 0.3 THEN 'low' WHEN p < 0.6 THEN 'medium' ELSE 'high' END AS tier FROM b_scored")
def d2_tier_service(spark, sf):
    return _s(spark, sf).select("id", d.risk_tier(F.col("p"), "service").alias("tier"))


@query("d3_tier_report", _S + "\nSELECT id, CASE WHEN p <= 0.33 THEN 'Low' WHEN p <= 0.66 THEN 'Medium' ELSE 'High' END AS tier FROM b_scored")
def d3_tier_report(spark, sf):
    return _s(spark, sf).select("id", d.risk_tier(F.col("p"), "report").alias("tier"))


@query("d4_action", _S + f"\nSELECT id, {_ACTION} AS action FROM b_scored")
def d4_action(spark, sf):
    return _s(spark, sf).select("id", d.recommended_action(F.col("p"), 0.5).alias("action"))


@query("d4_action_low_threshold", _S + f"\nSELECT id, {_ACTION.replace('0.5 + 0.15', '0.62 + 0.15').replace('p >= 0.5 THEN', 'p >= 0.62 THEN')} AS action FROM b_scored")
def d4_action_low_threshold(spark, sf):
    """A threshold above 0.55 brings the nudge level into play."""
    return _s(spark, sf).select("id", d.recommended_action(F.col("p"), 0.62).alias("action"))


@query("d5_action_high_value", _S + f"\nSELECT id, CASE {_LEVELS} WHEN MonthlyCharges * 2 >= 120 THEN 'Monitor + CSAT survey follow-up' ELSE 'No intervention needed' END AS action FROM b_scored")
def d5_action_high_value(spark, sf):
    return _s(spark, sf).select("id", d.recommended_action(F.col("p"), 0.5, F.col("MonthlyCharges") * 2).alias("action"))


@query("d6_value_telco", rounded_sql("WITH " + cte("b_telco") + """
--SELECT
SELECT customerID, coalesce(CASE WHEN tenure <> 3 THEN MonthlyCharges END, TRY_CAST(trim(TotalCharges) AS DOUBLE) / nullif(tenure, 0), 0) AS monthly_value FROM b_telco""", ["monthly_value"]))
def d6_value_telco(spark, sf):
    """The charge is blanked for one tenure so that the fallback runs."""
    df = bind(spark, sf, "b_telco").withColumn("MonthlyCharges", F.when(F.col("tenure") != 3, F.col("MonthlyCharges")))
    return rounded(df.select("customerID", d.monthly_value(df.columns, "telco").alias("monthly_value")), ["monthly_value"])


_FEATURES = "WITH " + cte("b_transactions") + ",\n" + ",\n".join([transactions_cte(), TXN_LINKED, TXN_FEATURES, TXN_LATEST])


@query("d7_value_subscription", rounded_sql(_FEATURES + """
--SELECT
SELECT msno, coalesce(CASE WHEN latest_payment_plan_days > 30 THEN latest_actual_amount_paid * 30 / latest_payment_plan_days END, avg_amount_paid, total_amount_paid, 0) AS monthly_value
FROM t_features JOIN t_latest USING (msno)""", ["monthly_value"]))
def d7_value_subscription(spark, sf):
    """One-month plans count as plans without days, so that the averages step in."""
    df = transaction_features(clean_transactions(bind(spark, sf, "b_transactions")))
    days = F.col("latest_payment_plan_days")
    df = df.withColumn("latest_payment_plan_days", F.when(days > 30, days).otherwise(0.0))
    return rounded(df.select("msno", d.monthly_value(df.columns, "subscription").alias("monthly_value")), ["monthly_value"])


@query("d8_revenue_at_risk", rounded_sql(_S + "\n--SELECT\nSELECT id, p * MonthlyCharges AS expected_revenue_at_risk FROM b_scored", ["expected_revenue_at_risk"]))
def d8_revenue_at_risk(spark, sf):
    df = _s(spark, sf)
    return rounded(df.select("id", (F.col("p") * d.monthly_value(df.columns, "telco")).alias("expected_revenue_at_risk")), ["expected_revenue_at_risk"])


def decided(spark, sf):
    return d.add_decisions(_s(spark, sf).withColumnRenamed("p", "churn_probability"), 0.5, "telco")


_DECIDED = (
    _S + f",\ndecided AS (SELECT id, y, p AS churn_probability, MonthlyCharges, CAST(p >= 0.5 AS INT) AS predicted_churn, {_BATCH_TIER} AS risk_tier, {_ACTION} AS recommended_action,"
    f" {_T} AS model_threshold, MonthlyCharges AS estimated_monthly_value, p * MonthlyCharges AS expected_revenue_at_risk FROM b_scored)"
)


@query("j5_attached_decisions", rounded_sql(_DECIDED + "\n--SELECT\nSELECT * FROM decided", ["expected_revenue_at_risk"]))
def j5_attached_decisions(spark, sf):
    return rounded(decided(spark, sf).drop("scored_at"), ["expected_revenue_at_risk"])


@query("d9_score_stamps", _DECIDED + "\nSELECT id, model_threshold, true AS stamped FROM decided")
def d9_score_stamps(spark, sf):
    """Stamped: every row carries the run's one time."""
    rows = decided(spark, sf)
    times = rows.agg(F.count_distinct("scored_at").alias("n"), F.max("scored_at").alias("at")).select(F.struct("n", "at").alias("t")).scalar()
    return rows.withColumn("_t", times).select("id", "model_threshold", ((F.col("_t.n") == 1) & F.col("scored_at").eqNullSafe(F.col("_t.at"))).alias("stamped"))


# ---------------------------------------------------------------- themes and drivers


def theme_sql(name: str) -> str:
    whens = " ".join(
        f"WHEN {' OR '.join(f'contains(lower({name}), {k!r})' for k in keywords)} THEN '{theme}'" for theme, keywords in THEME_KEYWORDS
    )
    return f"CASE {whens} ELSE 'Other' END"


_D = "WITH " + cte("b_drivers")


@query("d10_theme", _D + f"\nSELECT id, feature, {theme_sql('feature')} AS theme FROM b_drivers")
def d10_theme(spark, sf):
    return bind(spark, sf, "b_drivers").select("id", "feature", feature_theme(F.col("feature")).alias("theme"))


_IMPORTANCE = _D + ",\nimportance AS (SELECT feature, avg(abs(v0)) AS mean_abs_shap FROM b_drivers GROUP BY feature)"


def _importance(spark, sf):
    return bind(spark, sf, "b_drivers").groupBy("feature").agg(F.avg(F.abs("v0")).alias("mean_abs_shap"))


@query("a23_theme_rollup", rounded_sql(_IMPORTANCE + f"\n--SELECT\nSELECT {theme_sql('feature')} AS driver_theme, sum(mean_abs_shap) AS importance FROM importance GROUP BY 1", ["importance"]))
def a23_theme_rollup(spark, sf):
    return rounded(r.theme_rollup(_importance(spark, sf)), ["importance"])


NAMES = ["num__tenure", "num__MonthlyCharges", "cat__Contract_Two year", "num__price_ratio", "cat__TechSupport_No"]
_slots = " UNION ALL ".join(f"SELECT id, {i} AS slot, '{n}' AS feature, v{i} AS value FROM b_drivers" for i, n in enumerate(NAMES))
_TOP = _D + f""",
slots AS ({_slots}),
top3 AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(value) DESC, slot) AS k FROM slots QUALIFY k <= 3)"""


def _contributions(spark, sf):
    return bind(spark, sf, "b_drivers").select("id", "churn_probability", F.array("v0", "v1", "v2", "v3", "v4").alias("attributions"))


@query("k3_top_contributions", _TOP + "\nSELECT id, CAST(k AS INT) AS k, feature, value FROM top3")
def k3_top_contributions(spark, sf):
    top = top_contributions(F.col("attributions"), NAMES, 3)
    rows = _contributions(spark, sf).select("id", F.posexplode(top).alias("at", "entry"))
    return rows.select("id", (F.col("at") + 1).alias("k"), "entry.feature", "entry.value")


_DRIVERS = _TOP + f""",
themed AS (SELECT *, {theme_sql('feature')} AS theme FROM top3),
totals AS (SELECT id, theme, sum(abs(value) ORDER BY k) AS total, min(k) AS first_k FROM themed GROUP BY id, theme),
primary_theme AS (SELECT id, theme AS primary_driver_theme FROM totals QUALIFY row_number() OVER (PARTITION BY id ORDER BY total DESC, first_k) = 1),
sentences AS (SELECT id, {', '.join(f"max(CASE WHEN k = {k} THEN feature || ' (' || CASE WHEN value > 0 THEN 'increases' ELSE 'decreases' END || ' risk)' END) AS top_driver_{k}" for k in (1, 2, 3))} FROM top3 GROUP BY id),
explained AS (SELECT * FROM sentences JOIN primary_theme USING (id))"""


@query("d11_drivers", _DRIVERS + "\nSELECT * FROM explained")
def d11_drivers(spark, sf):
    return driver_columns(_contributions(spark, sf), NAMES).drop("attributions", "churn_probability")


# ---------------------------------------------------------------- roll-ups

_KPI_DOUBLES = ["high_risk_rate", "revenue_at_risk", "expected_loss_total", "avg_value_high_risk"]
_KPIS = """kpis AS (SELECT count(*) FILTER (WHERE churn_probability >= 0.5) AS high_risk_count, count(*) FILTER (WHERE churn_probability >= 0.5) / CAST(count(*) AS DOUBLE) AS high_risk_rate,
 sum(churn_probability * greatest(value, 0)) FILTER (WHERE churn_probability >= 0.5) AS revenue_at_risk, sum(churn_probability * greatest(value, 0)) AS expected_loss_total,
 avg(value) FILTER (WHERE churn_probability >= 0.5) AS avg_value_high_risk FROM (SELECT *, estimated_monthly_value - 20 AS value FROM decided) v)"""


def _valued(spark, sf):
    """Values shifted so that some are negative."""
    return decided(spark, sf).withColumn("estimated_monthly_value", F.col("estimated_monthly_value") - 20)


@query("a24_kpis", rounded_sql(_DECIDED + ",\n" + _KPIS + "\n--SELECT\nSELECT * FROM kpis", _KPI_DOUBLES))
def a24_kpis(spark, sf):
    return rounded(r.business_kpis(_valued(spark, sf), 0.5), _KPI_DOUBLES)


@query("a25_value_fallback", rounded_sql(_S + "\n--SELECT\nSELECT 'MonthlyCharges' AS value_column, sum(MonthlyCharges) AS total FROM b_scored", ["total"]))
def a25_value_fallback(spark, sf):
    df = _s(spark, sf)
    name = r.value_column(df.columns)
    return rounded(df.agg(F.lit(name).alias("value_column"), F.sum(name).alias("total")), ["total"])


@query("a26_action_counts", _DECIDED + "\nSELECT recommended_action, count(*) AS customer_count FROM decided WHERE churn_probability >= 0.5 GROUP BY 1")
def a26_action_counts(spark, sf):
    return r.action_counts(decided(spark, sf), 0.5)


@query("a27_theme_counts", _DRIVERS + "\nSELECT primary_driver_theme AS driver_theme, count(*) AS customer_count FROM explained JOIN b_drivers USING (id) WHERE churn_probability >= 0.5 GROUP BY 1")
def a27_theme_counts(spark, sf):
    return r.theme_counts(driver_columns(_contributions(spark, sf), NAMES), 0.5)


@query("a27_theme_fallback", rounded_sql(_IMPORTANCE + f"\n--SELECT\nSELECT {theme_sql('feature')} AS driver_theme, sum(mean_abs_shap) AS importance FROM importance GROUP BY 1", ["importance"]))
def a27_theme_fallback(spark, sf):
    """Scored rows without drivers fall back to the global importances."""
    return rounded(r.theme_counts(decided(spark, sf), 0.5, _importance(spark, sf)), ["importance"])


@query("a28_tier_distribution", _DECIDED + "\nSELECT risk_tier, count(*) AS customer_count FROM decided GROUP BY 1")
def a28_tier_distribution(spark, sf):
    return r.tier_distribution(decided(spark, sf))


@query("a31_snapshot", rounded_sql(_S + "\n--SELECT\nSELECT count(*) AS customers_scored, count(*) FILTER (WHERE p >= 0.5) AS predicted_high_risk, sum(p * MonthlyCharges) AS monthly_revenue_at_risk FROM b_scored", ["monthly_revenue_at_risk"]))
def a31_snapshot(spark, sf):
    return rounded(r.evaluation_snapshot(_s(spark, sf), 0.5, "p"), ["monthly_revenue_at_risk"])


@query("a32_mean_probability", rounded_sql(_S + "\n--SELECT\nSELECT avg(p) AS mean_churn_probability FROM b_scored", ["mean_churn_probability"]))
def a32_mean_probability(spark, sf):
    return rounded(r.mean_probability(_s(spark, sf), "p"), ["mean_churn_probability"])


@query("n12_revenue_at_risk", rounded_sql(_S + "\n--SELECT\nSELECT sum(p * MonthlyCharges) AS revenue_at_risk FROM b_scored", ["revenue_at_risk"]))
def n12_revenue_at_risk(spark, sf):
    return rounded(r.revenue_at_risk(_s(spark, sf), "p"), ["revenue_at_risk"])


@query("k2_top25", _DECIDED + "\nSELECT CAST(id AS STRING) AS customerID, churn_probability, risk_tier, recommended_action, MonthlyCharges FROM decided ORDER BY churn_probability DESC, CAST(id AS STRING) LIMIT 25")
def k2_top25(spark, sf):
    df = decided(spark, sf).withColumn("customerID", F.col("id").cast("string"))
    return r.top_risk_customers(df, 25)


@query("d12_business_insights", _DECIDED + ",\n" + _KPIS + f""",
themes AS (SELECT {theme_sql('feature')} AS driver_theme, count(*) AS n FROM ({cte('b_drivers').split(' AS (', 1)[1].rsplit(')', 1)[0]}) drivers WHERE churn_probability >= 0.5 GROUP BY 1),
top AS (SELECT driver_theme FROM themes ORDER BY n DESC, driver_theme LIMIT 1)
SELECT 0 AS line, high_risk_count || ' customers are above the current intervention threshold.' AS insight FROM kpis
UNION ALL SELECT 1, 'Estimated near-term revenue at risk (high-risk only): $' || format('{{:,.0f}}', revenue_at_risk) || '.' FROM kpis
UNION ALL SELECT 2, 'Portfolio-wide expected churn loss: $' || format('{{:,.0f}}', expected_loss_total) || ' per month.' FROM kpis
UNION ALL SELECT 3, 'Average value of a high-risk customer: $' || format('{{:,.0f}}', avg_value_high_risk) || '.' FROM kpis
UNION ALL SELECT 4, 'The most common driver theme among high-risk customers is ' || driver_theme || '.' FROM top""")
def d12_business_insights(spark, sf):
    themed = bind(spark, sf, "b_drivers").withColumn("primary_driver_theme", feature_theme(F.col("feature")))
    themes = r.theme_counts(themed, 0.5)
    return r.business_insights(r.business_kpis(_valued(spark, sf), 0.5), themes)
