"""Collects the queries of the sibling modules."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_MODULES = ["sources", "subscription", "telco", "splitting", "evaluation", "experiments", "decisions", "exploration", "learning"]
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with the SQL that must give the same rows."""
    def register(fn):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn
    return register


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"{__package__}.{module}")


def queries() -> dict:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


# Sums of doubles depend on their order in the last digits; both sides round what they compare.
# Engines break ties of decimal fractions differently, so values are first moved off the tie.
DIGITS = 6
NUDGE = 1e-9


def rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    def fixed(c: str) -> Column:
        return F.round(F.col(c).cast("double") + NUDGE, DIGITS) + F.lit(0.0)

    return df.withColumns({c: fixed(c) for c in columns})


def rounded_sql(sql: str, columns: list[str]) -> str:
    fixed = ", ".join(f"round(CAST({c} AS DOUBLE) + CAST({NUDGE} AS DOUBLE), {DIGITS}) + 0.0 AS {c}" for c in columns)
    head, body = _split_with(sql)
    return f"{head}SELECT * REPLACE ({fixed}) FROM ({body}) rounded_rows"


def _split_with(sql: str) -> tuple[str, str]:
    """(WITH clause, final SELECT); the final SELECT follows the marker ``--SELECT``."""
    head, marker, body = sql.partition("--SELECT\n")
    return (head, body) if marker else ("", sql)
