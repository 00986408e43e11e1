"""Global ranks and running totals without a one-task window.

Rows are sorted globally (a range shuffle over the whole sort key, so ties on the score alone do
not pile up in one task), stored with their position, and then numbered by adding up the row
counts of the stored ranges. Only those counts - one row per range - meet in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise

_RANGE_SHIFT = 33  # monotonically_increasing_id keeps the partition above bit 33


def _sorted_with_position(df: DataFrame, order: list[Column]) -> DataFrame:
    placed = df.orderBy(*order).withColumn("_position", F.monotonically_increasing_id())
    return materialise(placed, "ranked").withColumn("_range", F.shiftright("_position", _RANGE_SHIFT))


def _range_offsets(stored: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Per stored range: what lies before it, and the grand totals. As many rows as ranges."""
    totals = {"rank": F.count("*"), **{name: F.sum(value) for name, value in sums.items()}}
    per_range = stored.groupBy("_range").agg(*[v.alias(f"_in_{k}") for k, v in totals.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per_range.select(
        "_range",
        *[F.coalesce(F.sum(f"_in_{k}").over(before), F.lit(0)).alias(f"_before_{k}") for k in totals],
        *[F.sum(f"_in_{k}").over(everything).alias(f"_all_{k}") for k in totals],
    )


def with_global_rank(df: DataFrame, order: list[Column], rank: str = "rank", total: str = "total") -> DataFrame:
    """Add the 0-based position in ``order`` and the row count. ``order`` must be total."""
    stored = _sorted_with_position(df, order)
    offsets = _range_offsets(stored, {})
    within = F.col("_position").bitwiseAND(F.lit((1 << _RANGE_SHIFT) - 1))
    # Broadcast size: one row per sorted range.
    return stored.join(F.broadcast(offsets), "_range").select(
        *df.columns,
        (F.col("_before_rank") + within).alias(rank),
        F.col("_all_rank").alias(total),
    )


def with_running_totals(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Add, per entry of ``sums``, its inclusive running total and its grand total ``total_<name>``."""
    stored = _sorted_with_position(df, order)
    offsets = _range_offsets(stored, sums)
    inside = Window.partitionBy("_range").orderBy("_position").rowsBetween(Window.unboundedPreceding, 0)
    running = stored.withColumns({f"_run_{k}": F.sum(v).over(inside) for k, v in sums.items()})
    return running.join(F.broadcast(offsets), "_range").select(
        *df.columns,
        *[(F.col(f"_before_{k}") + F.col(f"_run_{k}")).alias(k) for k in sums],
        *[F.col(f"_all_{k}").alias(f"total_{k}") for k in sums],
    )


def with_previous(df: DataFrame, keys: list[str], order: list[Column], previous: dict[str, str]) -> DataFrame:
    """``lag`` by key in ``order``, whatever the size of a key: {output name: source column}.

    Sorted ranges may cut through a key. Inside a range the predecessor is the row before; the
    first row of a range takes the last row of the range before it.
    """
    stored = _sorted_with_position(df, [*map(F.col, keys), *order])
    needed = F.struct(*keys, *[c for c in previous.values() if c not in keys])
    ends = stored.groupBy("_range").agg(F.max_by(needed, "_position").alias("_end"))
    carried = ends.select("_range", F.lag("_end").over(Window.orderBy("_range")).alias("_carried"))
    in_range = Window.partitionBy("_range").orderBy("_position")
    rows = stored.withColumn("_before", F.lag(needed).over(in_range))
    # Broadcast size: one row per sorted range.
    linked = rows.join(F.broadcast(carried), "_range").withColumn("_before", F.coalesce("_before", "_carried"))
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col(f"_before.{k}").eqNullSafe(F.col(k))
    return linked.select(*df.columns, *[F.when(same_key, F.col(f"_before.{c}")).alias(name) for name, c in previous.items()])
