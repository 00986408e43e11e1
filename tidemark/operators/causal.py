"""Treatment effects, uplift tables and targeting policies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..fixed_values import SCORE_COLUMN_CANDIDATES
from .cuts import score_bins

CLIP = (1e-3, 1 - 1e-3)


@dataclass(frozen=True)
class ExperimentSchema:
    treatment: str = "treatment"
    outcome: str = "outcome"
    propensity: str | None = None
    segment: str | None = None


def _require(df: DataFrame, *names: str) -> None:
    missing = sorted(n for n in names if n not in df.columns)
    if missing:
        raise KeyError(f"missing required column(s): {', '.join(missing)}")


def _clipped(c: Column) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(CLIP[0])), F.lit(CLIP[1])))


def standardize_experiment(df: DataFrame, schema: ExperimentSchema = ExperimentSchema()) -> DataFrame:
    """Treatment as INT, outcome as DOUBLE, propensity clipped away from 0 and 1."""
    _require(df, schema.treatment, schema.outcome)
    coerced = {
        schema.treatment: F.col(schema.treatment).cast("int"),
        schema.outcome: F.col(schema.outcome).cast("double"),
    }
    if schema.propensity and schema.propensity in df.columns:
        coerced[schema.propensity] = _clipped(F.col(schema.propensity))
    return df.withColumns(coerced)


def inverse_propensity_weights(df: DataFrame, treatment: str = "treatment", propensity: str = "propensity", output: str = "ipw") -> DataFrame:
    _require(df, propensity)
    t, p = F.col(treatment), _clipped(F.col(propensity))
    return df.withColumn(output, t / p + (1 - t) / (1 - p))


def treatment_rate(df: DataFrame, treatment: str = "treatment") -> DataFrame:
    _require(df, treatment)
    return df.agg(F.avg(treatment).alias("treatment_rate"))


def _effect(groups, treatment: str, outcome: str, weight: str | None, higher_is_better: bool) -> DataFrame:
    w = F.col(weight).cast("double") if weight else F.lit(1.0)

    def arm_mean(value: int) -> Column:
        arm = F.col(treatment) == value
        return F.try_divide(F.sum(F.when(arm, w * F.col(outcome))), F.sum(F.when(arm, w)))

    means = groups.agg(arm_mean(1).alias("treated_mean"), arm_mean(0).alias("control_mean"))
    ate = F.col("treated_mean") - F.col("control_mean")
    better = ate > 0 if higher_is_better else ate < 0
    return means.withColumns({
        "ate": ate,
        "uplift_direction": F.when(better, "improves").otherwise("worsens"),
    })


def estimate_ate(df: DataFrame, treatment: str = "treatment", outcome: str = "outcome", weight: str | None = None, higher_is_better: bool = False) -> DataFrame:
    """One row: difference in (weighted) outcome means, and whether it points the good way."""
    _require(df, treatment, outcome)
    weight = weight if weight in df.columns else None
    return _effect(df.groupBy(), treatment, outcome, weight, higher_is_better).select(
        "ate", "treated_mean", "control_mean", "uplift_direction"
    )


def estimate_cate(df: DataFrame, segments: str | list[str], treatment: str = "treatment", outcome: str = "outcome", weight: str | None = None, higher_is_better: bool = False) -> DataFrame:
    """One effect row per segment combination, largest absolute effect first; NULL segments drop."""
    segments = [segments] if isinstance(segments, str) else list(segments)
    _require(df, *segments)
    _require(df, treatment, outcome)
    weight = weight if weight in df.columns else None
    effects = _effect(df.dropna(subset=segments).groupBy(*segments), treatment, outcome, weight, higher_is_better)
    return effects.select(*segments, "ate", "treated_mean", "control_mean", "uplift_direction").orderBy(
        F.abs("ate").desc_nulls_last(), *segments
    )


def score_column(columns: list[str], explicit: str | None = None) -> Column:
    """The explicit score if present, else the first known score column, else a constant."""
    for name in [explicit, *SCORE_COLUMN_CANDIDATES]:
        if name and name in columns:
            return F.col(name)
    return F.lit(1.0)


def uplift_table(df: DataFrame, score: str = "score", tie_break: str = "id", treatment: str = "treatment", outcome: str = "outcome", bins: int = 10) -> DataFrame:
    """Per score bin: size, response rate per arm, uplift, running uplift, overall control rate."""
    binned = score_bins(df.select(score, tie_break, treatment, outcome), score, tie_break, bins)

    def arm(value: int) -> Column:
        return F.when(F.col(treatment) == value, F.col(outcome))

    per_bin = binned.groupBy("bin").agg(
        F.count("*").alias("n_records"),
        F.coalesce(F.avg(arm(1)), F.lit(0.0)).alias("treated_rate"),
        F.coalesce(F.avg(arm(0)), F.lit(0.0)).alias("control_rate"),
        F.sum(arm(0)).alias("_control_sum"),
        F.count(arm(0)).alias("_control_n"),
    )
    # From here on there are at most `bins` rows.
    upto, everything = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    uplift = F.col("treated_rate") - F.col("control_rate")
    return per_bin.withColumn("uplift", uplift).select(
        "bin", "n_records", "treated_rate", "control_rate", "uplift",
        F.sum("uplift").over(upto).alias("cumulative_uplift"),
        F.try_divide(F.sum("_control_sum").over(everything), F.sum("_control_n").over(everything)).alias("control_baseline"),
    )


def recommend_policy(table: DataFrame, treatment_cost: float = 0.0, value_per_success: float = 1.0, budget_fraction: float = 1.0, only_positive: bool = False) -> DataFrame:
    """Treat the first floor((bins-1)*budget)+1 bins; holdout bins carry the final gain.

    ``only_positive`` leaves bins whose expected gain is not positive untreated.
    """
    by_bin, everything = Window.orderBy("bin"), Window.partitionBy()
    upto = by_bin.rowsBetween(Window.unboundedPreceding, 0)
    gain = F.col("uplift") * F.col("n_records") * float(value_per_success) - F.col("n_records") * float(treatment_cost)
    eligible = F.row_number().over(by_bin) - 1 <= F.floor((F.count("*").over(everything) - 1) * F.lit(float(budget_fraction)))
    marked = table.withColumn("treat", eligible)
    if only_positive:
        marked = marked.withColumn("treat", F.col("treat") & (gain > 0))
    treat = F.col("treat")
    return marked.withColumns({
        "expected_successes": F.when(treat, F.col("uplift") * F.col("n_records")).otherwise(0.0),
        "expected_gain": F.when(treat, gain).otherwise(0.0),
    }).withColumn("cumulative_gain", F.sum("expected_gain").over(upto)).select(
        *table.columns, "expected_successes", "expected_gain", "cumulative_gain", "treat"
    )


def causal_summary(ate: DataFrame, table: DataFrame, budget_fraction: float) -> DataFrame:
    """One row: the ATE with the last running uplift (qini) and the top bin's uplift."""
    ends = table.agg(
        F.max_by("cumulative_uplift", "bin").alias("qini"), F.min_by("uplift", "bin").alias("uplift_top_bin")
    ).select(F.struct("qini", "uplift_top_bin").alias("ends")).scalar()
    return ate.select(
        "ate", "treated_mean", "control_mean", "uplift_direction",
        F.coalesce(ends.getField("qini"), F.lit(0.0)).alias("qini"),
        F.coalesce(ends.getField("uplift_top_bin"), F.lit(0.0)).alias("uplift_top_bin"),
        F.lit(float(budget_fraction)).alias("budget_fraction"),
    )
