"""Parts of an order by score and id, found by cut keys: no row is moved, and no wide row is sorted.

The score at a rank comes from the exact order statistics; only the ids of rows that tie with a cut score are sorted, by range.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .quantiles import values_at_ranks
from .ranking import with_global_rank


def _keys_at(df: DataFrame, score: str, tie_break: str, ranks: list[int], n_scored: int) -> list[tuple]:
    """(score, id) at 0-based ``ranks`` by score, highest first and NULL last, then id. A few values per rank reach the driver."""
    scored = sorted({r for r in ranks if r < n_scored})
    value = dict(zip(scored, values_at_ranks(df, score, [n_scored - 1 - r for r in scored])))
    cuts = [value.get(r) for r in ranks]
    number = F.col(score).cast("double")

    def above(cut) -> Column:
        return F.count_if(number.isNotNull() if cut is None else number > F.lit(cut))

    before = df.agg(*[above(c).alias(f"b{i}") for i, c in enumerate(cuts)]).first()
    tied = number.isNull() if None in cuts else F.lit(False)
    if known := sorted({c for c in cuts if c is not None}):
        tied = tied | number.isin(known)
    ties = df.filter(tied).select(number.alias("_score"), F.col(tie_break).alias("_id"))
    placed = with_global_rank(ties, [F.col("_score").desc_nulls_last(), F.col("_id").asc()], "_rank", "_total")
    starts = {r["_score"]: r["start"] for r in placed.groupBy("_score").agg(F.min("_rank").alias("start")).collect()}
    at = [starts[c] + r - b for c, r, b in zip(cuts, ranks, before)]
    ids = {r["_rank"]: r["_id"] for r in placed.filter(F.col("_rank").isin(at)).select("_rank", "_id").collect()}
    return [(c, ids[a]) for c, a in zip(cuts, at)]


def _upto(score: str, tie_break: str, key: tuple) -> Column:
    """Whether a row stands at ``key`` or before it."""
    number, (cut, last) = F.col(score).cast("double"), key
    if cut is None:
        return number.isNotNull() | (F.col(tie_break) <= F.lit(last))
    return F.coalesce((number > F.lit(cut)) | ((number == F.lit(cut)) & (F.col(tie_break) <= F.lit(last))), F.lit(False))


def _sizes(df: DataFrame, score: str) -> tuple[int, int]:
    return tuple(df.agg(F.count("*"), F.count(score)).first())


def top_share(df: DataFrame, score: str, tie_break: str, budget: float) -> DataFrame:
    """The highest ``max(1, floor(n * budget))`` rows by score; ``tie_break`` is unique."""
    total, scored = _sizes(df, score)
    keep = min(max(1, math.floor(total * float(budget))), total)
    if not keep:
        return df
    (key,) = _keys_at(df, score, tie_break, [keep - 1], scored)
    return df.filter(_upto(score, tie_break, key))


def score_bins(df: DataFrame, score: str, tie_break: str, bins: int = 10) -> DataFrame:
    """Add ``bin``: right-closed quantile bin of the row's position by score, highest first.

    Bin b ends at position floor((n - 1) * (b + 1) / bins), so sizes differ from ``ntile``. A single row is bin 0.
    """
    total, scored = _sizes(df, score)
    ends = [(total - 1) * (b + 1) // bins for b in range(bins - 1)] if total > 1 else []
    keys = _keys_at(df, score, tie_break, ends, scored) if ends else []
    number = F.lit(0)
    for key in keys:
        number = number + (~_upto(score, tie_break, key)).cast("int")
    return df.withColumn("bin", number.cast("int"))
