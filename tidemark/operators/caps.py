"""Winsorising as a fitted state: caps learned from some rows, kept as a small table and applied to any others."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed_values import CAPPED_COLUMNS
from .quantiles import fit_caps

CAPS_SCHEMA = "column string, low double, high double"


@dataclass(frozen=True)
class Caps:
    """(low, high) per capped column, a few numbers; None where the column had no value to learn from, which then caps nothing."""

    bounds: dict[str, tuple[float | None, float | None]]

    @classmethod
    def fitted(cls, rows: DataFrame, columns: list[str] | None = None) -> Caps:
        """Learn from ``rows``, which are read twice with the capped columns alone: store them first when they are costly."""
        pairs = fit_caps(rows, columns).first().asDict()
        return cls({name: tuple(pair) for name, pair in pairs.items()})

    @classmethod
    def of_rows(cls, rows: list[dict] | None) -> Caps | None:
        """From rows of ``table``; None of none, as runs without caps have."""
        return cls({r["column"]: (r["low"], r["high"]) for r in rows}) if rows else None

    @property
    def rows(self) -> list[dict]:
        return [{"column": c, "low": low, "high": high} for c, (low, high) in self.bounds.items()]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, CAPS_SCHEMA)

    def applied(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<column>_capped`` for each column it has, in place of what stood under that name; NULL stays NULL.

        Capped columns whose source column is gone, as in stored test rows, are left as they are.
        """
        def clipped(name: str):
            value, (low, high) = F.col(f"`{name}`").try_cast("double"), self.bounds[name]
            floor = value if low is None else F.greatest(value, F.lit(low))
            return F.when(value.isNotNull(), floor if high is None else F.least(floor, F.lit(high)))

        return df.withColumns({f"{c}_capped": clipped(c) for c in self.bounds if c in df.columns})


def capped_pairs(df: DataFrame) -> list[str]:
    """The columns of ``df`` that it also has capped, and so the ones whose caps a run must learn."""
    return [c for c in CAPPED_COLUMNS if c in df.columns and f"{c}_capped" in df.columns]
