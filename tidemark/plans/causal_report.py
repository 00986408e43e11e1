"""Experiment table to effect, segment, uplift and policy tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import causal as c
from ..session import materialise


def causal_report(df: DataFrame, id_col: str, treatment: str = "treatment", outcome: str = "outcome", segment: str | None = "segment",
                  score: str | None = None, budget: float = 0.3, treatment_cost: float = 0.0, value_per_save: float = 1.0) -> dict[str, DataFrame]:
    segment = segment if segment in df.columns else None
    rows = c.standardize_experiment(df, c.ExperimentSchema(treatment, outcome, segment=segment))
    ate = c.estimate_ate(rows, treatment, outcome)
    scored = rows.withColumn("_score", c.score_column(rows.columns, score))
    # At most ten rows with three consumers: stored once.
    table = materialise(c.uplift_table(scored, "_score", id_col, treatment, outcome), "uplift")
    return {
        "summary": c.causal_summary(ate, table, budget),
        "cate": c.estimate_cate(rows, segment, treatment, outcome) if segment else None,
        "uplift_table": table,
        "policy": c.recommend_policy(table, treatment_cost, value_per_save, budget),
    }
