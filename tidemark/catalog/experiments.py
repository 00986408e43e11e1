"""Treatment effects, uplift and policy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import causal as c
from ..operators.cuts import top_share
from ..operators.reporting import causal_insights, causal_view
from ..plans.causal_report import causal_report
from .bindings import bind, cte
from .registry import query, rounded, rounded_sql

_E = "WITH " + cte("b_experiment")
_MEANS = ["ate", "treated_mean", "control_mean"]


def _effect_sql(weight: str = "1.0::DOUBLE", keys: str = "") -> str:
    group = f" GROUP BY {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    return (
        f"SELECT {lead}treated_mean - control_mean AS ate, treated_mean, control_mean, CASE WHEN treated_mean - control_mean < 0 THEN 'improves' ELSE 'worsens' END AS uplift_direction FROM"
        f" (SELECT {lead}sum({weight} * outcome) FILTER (WHERE treatment = 1) / sum({weight}) FILTER (WHERE treatment = 1) AS treated_mean,"
        f" sum({weight} * outcome) FILTER (WHERE treatment = 0) / sum({weight}) FILTER (WHERE treatment = 0) AS control_mean FROM b_experiment{group}) m"
    )


def _x(spark, sf):
    return bind(spark, sf, "b_experiment")


@query("p17_standardise", _E + "\nSELECT id, treatment, outcome, segment, greatest(least(propensity, 0.999::DOUBLE), 0.001::DOUBLE) AS propensity, score FROM b_experiment")
def p17_standardise(spark, sf):
    return c.standardize_experiment(_x(spark, sf), c.ExperimentSchema(propensity="propensity"))


_IPW = "treatment / greatest(least(propensity, 0.999::DOUBLE), 0.001::DOUBLE) + (1 - treatment) / (1 - greatest(least(propensity, 0.999::DOUBLE), 0.001::DOUBLE))"


@query("p18_ipw", rounded_sql(_E + f"\n--SELECT\nSELECT id, {_IPW} AS ipw FROM b_experiment", ["ipw"]))
def p18_ipw(spark, sf):
    return rounded(c.inverse_propensity_weights(_x(spark, sf)).select("id", "ipw"), ["ipw"])


@query("p19_score_choice", _E + "\nSELECT id, score AS explicit_score, propensity AS known_score, 1.0::DOUBLE AS uniform_score FROM b_experiment")
def p19_score_choice(spark, sf):
    df = _x(spark, sf)
    renamed = df.withColumnRenamed("propensity", "churn_probability")
    return renamed.select(
        "id", c.score_column(renamed.columns, "score").alias("explicit_score"), c.score_column(renamed.columns).alias("known_score"),
        c.score_column(df.columns).alias("uniform_score"),
    )


@query("a6_ate", rounded_sql(_E + "\n--SELECT\n" + _effect_sql(), _MEANS))
def a6_ate(spark, sf):
    return rounded(c.estimate_ate(_x(spark, sf)), _MEANS)


@query("a6_weighted_ate", rounded_sql(_E + "\n--SELECT\n" + _effect_sql(f"({_IPW})"), _MEANS))
def a6_weighted_ate(spark, sf):
    return rounded(c.estimate_ate(c.inverse_propensity_weights(_x(spark, sf)), weight="ipw"), _MEANS)


@query("a7_cate", rounded_sql(_E + "\n--SELECT\n" + _effect_sql(keys="segment"), _MEANS))
def a7_cate(spark, sf):
    return rounded(c.estimate_cate(_x(spark, sf), "segment"), _MEANS)


@query("a8_treatment_rate", rounded_sql(_E + "\n--SELECT\nSELECT avg(treatment) AS treatment_rate FROM b_experiment", ["treatment_rate"]))
def a8_treatment_rate(spark, sf):
    return rounded(c.treatment_rate(_x(spark, sf)), ["treatment_rate"])


_BINS = _E + """,
ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) - 1 AS i, count(*) OVER () AS n FROM b_experiment),
binned AS (SELECT *, CAST(greatest((i * 10 + n - 2) // (n - 1) - 1, 0) AS INT) AS bin FROM ranked)"""
_TABLE = _BINS + """,
bins AS (SELECT bin, count(*) AS n_records, coalesce(avg(outcome) FILTER (WHERE treatment = 1), 0) AS treated_rate, coalesce(avg(outcome) FILTER (WHERE treatment = 0), 0) AS control_rate FROM binned GROUP BY bin),
uplifts AS (SELECT *, treated_rate - control_rate AS uplift, sum(treated_rate - control_rate) OVER (ORDER BY bin) AS cumulative_uplift,
 (SELECT avg(outcome) FROM b_experiment WHERE treatment = 0) AS control_baseline FROM bins)"""
_POLICY = _TABLE + """,
eligible AS (SELECT *, row_number() OVER (ORDER BY bin) - 1 <= floor((count(*) OVER () - 1) * 0.5) AS treat FROM uplifts),
gains AS (SELECT *, CASE WHEN treat THEN uplift * n_records ELSE 0 END AS expected_successes, CASE WHEN treat THEN uplift * n_records * 5 - n_records * 1 ELSE 0 END AS expected_gain FROM eligible),
policy AS (SELECT *, sum(expected_gain) OVER (ORDER BY bin) AS cumulative_gain FROM gains)"""
_TABLE_DOUBLES = ["treated_rate", "control_rate", "uplift", "cumulative_uplift", "control_baseline"]
_POLICY_DOUBLES = _TABLE_DOUBLES + ["expected_successes", "expected_gain", "cumulative_gain"]


@query("w3_quantile_bins", _BINS + "\nSELECT id, bin FROM binned")
def w3_quantile_bins(spark, sf):
    return c.score_bins(_x(spark, sf), "score", "id").select("id", "bin")


UPLIFT_SQL = rounded_sql(_TABLE + "\n--SELECT\nSELECT * FROM uplifts", _TABLE_DOUBLES)


@query("a9_uplift_table", UPLIFT_SQL)
def a9_uplift_table(spark, sf):
    return rounded(c.uplift_table(_x(spark, sf)), _TABLE_DOUBLES)


@query("a9_uniform_score", rounded_sql(_TABLE.replace("ORDER BY score DESC, id", "ORDER BY id") + "\n--SELECT\nSELECT * FROM uplifts", _TABLE_DOUBLES))
def a9_uniform_score(spark, sf):
    """Every row ties on the constant score; the id alone decides the bins."""
    df = _x(spark, sf).withColumn("score", F.lit(1.0))
    return rounded(c.uplift_table(df), _TABLE_DOUBLES)


@query("w4_running_uplift", rounded_sql(_TABLE + "\n--SELECT\nSELECT bin, cumulative_uplift FROM uplifts", ["cumulative_uplift"]))
def w4_running_uplift(spark, sf):
    return rounded(c.uplift_table(_x(spark, sf)).select("bin", "cumulative_uplift"), ["cumulative_uplift"])


@query("w5_policy", rounded_sql(_POLICY + "\n--SELECT\nSELECT * FROM policy", _POLICY_DOUBLES))
def w5_policy(spark, sf):
    return rounded(c.recommend_policy(c.uplift_table(_x(spark, sf)), 1.0, 5.0, 0.5), _POLICY_DOUBLES)


@query("j4_holdout_bins", _POLICY + "\nSELECT bin, n_records FROM policy WHERE NOT treat")
def j4_holdout_bins(spark, sf):
    policy = c.recommend_policy(c.uplift_table(_x(spark, sf)), 1.0, 5.0, 0.5)
    return policy.filter(~F.col("treat")).select("bin", "n_records")


@query("u2_policy_bins", _POLICY + "\nSELECT bin, treat FROM policy")
def u2_policy_bins(spark, sf):
    return c.recommend_policy(c.uplift_table(_x(spark, sf)), 1.0, 5.0, 0.5).select("bin", "treat")


@query("k1_top_share", _E + "\nSELECT id, score FROM b_experiment QUALIFY row_number() OVER (ORDER BY score DESC, id) <= greatest(1, floor(count(*) OVER () * 0.2::DOUBLE))")
def k1_top_share(spark, sf):
    return top_share(_x(spark, sf), "score", "id", 0.2).select("id", "score")


_SUMMARY_DOUBLES = _MEANS + ["qini", "uplift_top_bin"]


def _summary_sql() -> str:
    ends = "(SELECT cumulative_uplift FROM uplifts ORDER BY bin DESC LIMIT 1) AS qini, (SELECT uplift FROM uplifts ORDER BY bin LIMIT 1) AS uplift_top_bin"
    return f"SELECT e.*, {ends}, 0.5::DOUBLE AS budget_fraction FROM ({_effect_sql()}) e"


@query("a30_causal_summary", rounded_sql(_POLICY + "\n--SELECT\nSELECT *, (SELECT sum(expected_gain) FROM policy) AS total_expected_gain FROM (" + _summary_sql() + ") s", _SUMMARY_DOUBLES + ["total_expected_gain"]))
def a30_causal_summary(spark, sf):
    bundle = causal_report(_x(spark, sf), "id", score="score", budget=0.5, treatment_cost=1.0, value_per_save=5.0)
    return rounded(causal_view(bundle["summary"], bundle["policy"]), _SUMMARY_DOUBLES + ["total_expected_gain"])


@query("d12_causal_insights", _POLICY + ",\ns AS (" + _summary_sql() + """),
g AS (SELECT sum(expected_gain) AS gain FROM policy)
SELECT 0 AS line, 'Treatment ' || CASE WHEN ate < 0 THEN 'reduced' ELSE 'increased' END || ' churn by ' || format('{:,.1f}', abs(ate * 100)) || ' pts on average.' AS insight FROM s
UNION ALL SELECT 1, 'Top uplift bin shows ' || format('{:.1f}', uplift_top_bin * 100) || ' pt lift; focus top ' || format('{:.0f}', budget_fraction * 100) || '% customers.' FROM s
UNION ALL SELECT 2, 'Expected net gain from policy: ' || format('{:,.1f}', gain) || ' value units.' FROM g""")
def d12_causal_insights(spark, sf):
    bundle = causal_report(_x(spark, sf), "id", score="score", budget=0.5, treatment_cost=1.0, value_per_save=5.0)
    return causal_insights(bundle["summary"], bundle["policy"])
