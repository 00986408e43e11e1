"""Exact order statistics without collecting a column in one task.

``percentile`` keeps every distinct value in its final task. Here one pass brackets each wanted
rank with a quantile sketch, merged in two levels so that no task merges one sketch per input
split; a second pass counts what lies below each bracket and shuffles only the few values inside it, ordered by range
over all targets. The sketch only chooses the bracket: a rank outside it has its bracket widened and is read again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import CAP_PROBABILITIES, CAPPED_COLUMNS
from .ranking import with_running_totals

# A sketch of this size errs by about 0.1 % of the rows; brackets reach several times that.
SKETCH_SIZE = 4_000
SLACK = 0.005
# Sketches of one series are first merged in this many groups.
MERGE_GROUPS = 256


def _sketches(df: DataFrame, names: list[str]) -> DataFrame:
    """One row: the count of each series, then its merged sketch. No row is copied per series."""
    parts = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("part")).agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(names)],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), SKETCH_SIZE).alias(f"s_{i}") for i, c in enumerate(names)],
    )
    return parts.agg(*[F.sum(f"n_{i}").alias(f"n_{i}") for i in range(len(names))],
                     *[F.kll_merge_agg_double(f"s_{i}").alias(f"s_{i}") for i in range(len(names))])


def _rank(n: int, place: float | int) -> float | int:
    return place if isinstance(place, int) else (n - 1) * place


def _order_statistics(df: DataFrame, names: list[str], wanted: list[tuple[str, float | int]]) -> list[tuple]:
    """Per (series, place) its (low value, high value, fraction) around the rank, or None without values.

    A place is a 0-based rank (int), or a probability (float) for rank (n - 1) * probability.

    Only counts, brackets and results, a few numbers per target, come to the driver.
    """
    row = _sketches(df, names).first()
    counts, sketches = [n or 0 for n in row[:len(names)]], row[len(names):]
    held = df.sparkSession.createDataFrame([sketches], ", ".join(f"s_{i} binary" for i in range(len(names))))

    def brackets(targets: list[int], slack: float) -> dict[int, tuple]:
        """(n, low end, high end) around the ranks next to each target's; an end beyond the column is None."""
        asked = {}
        for t in targets:
            i = names.index(wanted[t][0])
            rank = _rank(counts[i], wanted[t][1])
            for side, place in enumerate(((math.floor(rank) - 1) / counts[i] - slack, (math.ceil(rank) + 2) / counts[i] + slack)):
                if 0 < place < 1:
                    asked[t, side] = F.kll_sketch_get_quantile_double(F.col(f"s_{i}"), F.lit(place))
        ends = dict(zip(asked, held.select(*[c.alias(f"e_{k}") for k, c in enumerate(asked.values())]).first())) if asked else {}
        return {t: (counts[names.index(wanted[t][0])], ends.get((t, 0)), ends.get((t, 1))) for t in targets}

    found: list[tuple | None] = [None] * len(wanted)
    slack, left = SLACK, [t for t, (name, _) in enumerate(wanted) if counts[names.index(name)]]
    while left:
        for t, value in _ranked(df, wanted, brackets(left, slack)).items():
            found[t] = value
        left, slack = [t for t in left if found[t] is None], slack * 8
    return found


def _ranked(df: DataFrame, wanted: list[tuple[str, float]], brackets: dict[int, tuple]) -> dict[int, tuple]:
    """The targets whose ranks lie inside their brackets (n, low end, high end; None is open)."""
    def bound(t: int) -> tuple[Column, Column]:
        value, (_, low, high) = F.col(wanted[t][0]), brackets[t]
        below = F.lit(False) if low is None else value < F.lit(low)
        return below, value.isNotNull() & ~below & (F.lit(True) if high is None else value <= F.lit(high))

    under = df.agg(*[F.count_if(bound(t)[0]).alias(str(t)) for t in brackets]).first()
    inside = F.array(*[F.when(bound(t)[1], F.struct(F.lit(t).alias("target"), F.col(wanted[t][0]).cast("double").alias("value"))) for t in brackets])
    values = df.select(F.explode(F.filter(inside, lambda x: x.isNotNull())).alias("v")).groupBy("v.target", "v.value").agg(F.count("*").alias("rows"))
    placed = with_running_totals(values, [F.col("target"), F.col("value")], {"upto": F.col("rows")})
    first = placed.groupBy("target").agg(F.min(F.col("upto") - F.col("rows")).alias("before"))  # a row per target
    ranks = F.create_map(*[x for t, (n, _, _) in brackets.items() for x in (F.lit(t), F.lit(float(_rank(n, wanted[t][1]))))])
    below = F.create_map(*[x for t in brackets for x in (F.lit(t), F.lit(under[str(t)]))])
    last = F.col("upto") - F.col("before") + below[F.col("target")] - 1
    numbered = placed.join(F.broadcast(first), "target").select("target", "value", last.alias("last"), (last - F.col("rows") + 1).alias("first"), ranks[F.col("target")].alias("rank"))

    def at(position: Column) -> Column:
        return F.max(F.when(position.between(F.col("first"), F.col("last")), F.col("value")))

    rows = numbered.groupBy("target").agg(at(F.floor("rank")).alias("low"), at(F.ceil("rank")).alias("high")).collect()
    fraction = {t: _rank(n, wanted[t][1]) % 1 for t, (n, _, _) in brackets.items()}
    return {r["target"]: (r["low"], r["high"], fraction[r["target"]]) for r in rows if r["low"] is not None and r["high"] is not None}


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """One row; per column an array of exact linearly interpolated quantiles, NULL/NaN ignored.

    ``df`` is read three times with only ``columns``, and more often where a bracket must be widened: materialise it
    first when it is costly.
    """
    probabilities = [float(p) for p in probabilities]
    number = {name: F.col(name).cast("double") for name in columns}
    numeric = df.select(*[F.when(~F.isnan(c), c).alias(f"c{i}") for i, c in enumerate(number.values())])
    names = [f"c{i}" for i in range(len(columns))]
    found = _order_statistics(numeric, names, [(name, p) for name in names for p in probabilities])
    values = [None if x is None else x[0] + (x[1] - x[0]) * x[2] for x in found]
    k = len(probabilities)
    row = tuple(values[i * k:(i + 1) * k] for i in range(len(columns)))
    return df.sparkSession.createDataFrame([row], ", ".join(f"`{c}` array<double>" for c in columns))


def values_at_ranks(df: DataFrame, column: str, ranks: list[int]) -> list[float]:
    """The values of a numeric column at 0-based ascending ``ranks`` among those that are not NULL."""
    numeric = df.select(F.col(column).cast("double").alias("c0"))
    return [low for low, _, _ in _order_statistics(numeric, ["c0"], [("c0", int(r)) for r in ranks])] if ranks else []


def grouped_ranks(df: DataFrame, group: str, wanted: DataFrame) -> DataFrame:
    """Rows (group, part, value): of each group the value at the 0-based ``rank`` of ``wanted`` (group, part, rank).

    ``df`` has ``group`` and ``value``. Distinct values are numbered by a sort by range over group and value, so neither a large
    group nor many groups meet in one task; negative ranks have no row.
    """
    values = df.groupBy(group, "value").agg(F.count("*").alias("rows"))
    placed = with_running_totals(values, [F.col(group).asc_nulls_first(), F.col("value")], {"upto": F.col("rows")})
    starts = placed.groupBy(F.col(group).alias("_of")).agg(F.min(F.col("upto") - F.col("rows")).alias("before"))
    targets = wanted.join(starts, F.col(group).eqNullSafe(F.col("_of"))).select(
        F.col(group).alias("_group"), "part", (F.col("rank") + F.col("before")).alias("at")).filter(F.col("rank") >= 0)
    hit = placed[group].eqNullSafe(F.col("_group")) & (F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("rows"))
    return placed.join(targets, hit).select(group, "part", "value")


def fit_caps(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row of [p1, p99] pairs for the heavy-tailed columns that are present."""
    columns = [c for c in (columns or CAPPED_COLUMNS) if c in df.columns]
    numeric = df.select(*[F.col(c).try_cast("double").alias(c) for c in columns])
    return exact_quantiles(numeric, columns, list(CAP_PROBABILITIES))


def apply_caps(df: DataFrame, caps: DataFrame) -> DataFrame:
    """Add ``<column>_capped``, clipped to the fitted pair; NULL stays NULL."""
    row = caps.select(F.struct(*caps.columns).alias("caps")).scalar()

    def clipped(name: str) -> Column:
        value = F.col(name).try_cast("double")
        pair = F.col("_caps").getField(name)
        return F.when(value.isNotNull(), F.least(F.greatest(value, pair[0]), pair[1]))

    capped = {f"{c}_capped": clipped(c) for c in caps.columns if c in df.columns}
    return df.withColumn("_caps", row).withColumns(capped).drop("_caps")


def add_capped_columns(df: DataFrame) -> DataFrame:
    """Fit on ``df`` and apply to it."""
    return apply_caps(df, fit_caps(df))
