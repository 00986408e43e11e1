"""Isotonic regression without a row per score in one place.

Pooling adjacent violators is the greatest convex minorant of the running totals (weight, weighted label): its corners are the
ends of the pooled blocks and its slopes their values. Ranges of sorted scores pool their own rows, which leaves convex chains of
corners; neighbouring chains are then joined in pairs, round by round. Two chains are joined by their common tangent: all
corners right of its left end and left of its right end go. The tangent is found by steps of its slope: for a slope, an aggregate finds the
lowest corner of each side, and the line through both is the next slope, until it stays. Corners never leave their table
but to be counted; what the driver sees is a slope per pair of chains.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .ranking import with_running_totals

#: Blocks that a fitted map may have. Labels of 0 and 1 in n rows give n ** (2 / 3) at most; more are an error, never cut.
MOST_BLOCKS = 5_000_000
#: Steps of one round's slopes; a third of them halve the bracket, so more are an error.
MOST_STEPS = 200


def _pooled(batches):
    """Corners of the convex minorant of each task's sorted points; rows (x0, x1, w, s, dw, ds), where dw and ds are those of the block that ends there.

    Points must come in the order of their weight totals. What a task holds are its blocks.
    """
    blocks: list[list[float]] = []  # first score, last score, totals up to its end, its own weight and weighted label
    for b in batches:
        for x, w, s, dw, ds in zip(*(b[c].to_pylist() for c in ("x", "w", "s", "dw", "ds"))):
            block = [x, x, w, s, dw, ds]
            while blocks and blocks[-1][5] * block[4] >= block[5] * blocks[-1][4]:  # the mean before is not smaller
                before = blocks.pop()
                block = [before[0], *block[1:4], before[4] + block[4], before[5] + block[5]]
            blocks.append(block)
    if blocks:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in zip(*blocks)], ["x0", "x1", "w", "s", "dw", "ds"])


def _chains(points: DataFrame) -> DataFrame:
    """Stored corners of every range of points: (chain, x0, x1, w, s, dw, ds), chains numbered in order of scores."""
    placed = with_running_totals(points, [F.col("x")], {"w": F.col("dw"), "s": F.col("ds")}).select("x", "w", "s", "dw", "ds")
    ranged = placed.repartitionByRange("x").sortWithinPartitions("x")
    pooled = ranged.mapInArrow(_pooled, "x0 double, x1 double, w double, s double, dw double, ds double")
    return materialise(pooled.withColumn("chain", F.spark_partition_id()), "chains")


def _tangents(corners: DataFrame, slopes: DataFrame) -> DataFrame:
    """Per pair of chains the lowest corner of each side under the pair's slope: (pair, wl, sl, wr, sr); the outermost corner of equal ones.

    A left chain also has the point where its first block begins.
    """
    at = corners.join(F.broadcast(slopes), "pair")
    start = F.struct((F.col("w") - F.col("dw")).alias("w"), (F.col("s") - F.col("ds")).alias("s"))
    both = at.select("pair", "left", "slope", F.explode(F.array(F.struct("w", "s"), start)).alias("p")).select("pair", "left", "slope", "p.w", "p.s")
    height = F.col("s") - F.col("slope") * F.col("w")

    def lowest(side, sign):
        here = F.when(side, F.struct(height.alias("h"), (sign * F.col("w")).alias("o"), "w", "s"))
        return F.min(here)

    found = both.groupBy("pair").agg(lowest(F.col("left"), 1).alias("l"), lowest(~F.col("left"), -1).alias("r"))
    return found.select("pair", F.col("l.w").alias("wl"), F.col("l.s").alias("sl"), F.col("r.w").alias("wr"), F.col("r.s").alias("sr"))


class _Slope:
    """The search for one tangent's slope: steps along the line through the lowest corners, halving where these leave the bracket or take turns."""

    def __init__(self, slope: float):
        self.slope, self._low, self._high, self._steps = slope, -math.inf, math.inf, 0

    def settled(self, wl: float, sl: float, wr: float, sr: float) -> bool:
        """Whether the line through (wl, sl) and (wr, sr), lowest under the present slope, is the tangent; else the slope moves."""
        if wr <= wl:
            return True
        line = (sr - sl) / (wr - wl)
        if line == self.slope:
            return True
        if line > self.slope:
            self._low = self.slope
        else:
            self._high = self.slope
        self._steps += 1
        middle = (self._low + self._high) / 2
        outside = not self._low < line < self._high
        self.slope, before = middle if math.isfinite(middle) and (outside or self._steps % 3 == 0) else line, self.slope
        return self.slope in (before, self._low, self._high)


_LINES = "pair int, slope double, wl double, sl double, wr double, sr double"


def _joined(chains: DataFrame) -> DataFrame:
    """The chains after one round: neighbours 2 k and 2 k + 1 as chain k."""
    spark = chains.sparkSession
    corners = chains.withColumns({"pair": F.floor(F.col("chain") / 2).cast("int"), "left": F.col("chain") % 2 == 0})
    # Where the chains meet: the mean of the last block of the left one and the first of the right one begins the search.
    ends = corners.groupBy("pair").agg(
        F.max_by(F.struct("w", "dw", "s", "ds"), F.when(F.col("left"), F.col("w"))).alias("l"), F.min_by(F.struct("w", "dw", "s", "ds"), F.when(~F.col("left"), F.col("w"))).alias("r"),
        F.count_if("left").alias("n_left"), F.count_if(~F.col("left")).alias("n_right")).filter("n_left > 0 AND n_right > 0")
    first = ends.select("pair", ((F.col("l.ds") + F.col("r.ds")) / (F.col("l.dw") + F.col("r.dw"))).alias("slope")).collect()  # a number per pair of chains
    searches, lines = {r["pair"]: _Slope(r["slope"]) for r in first}, {}
    for _ in range(MOST_STEPS):
        if not searches:
            break
        slopes = spark.createDataFrame([(pair, search.slope) for pair, search in searches.items()], "pair int, slope double")
        for r in _tangents(corners, slopes).collect():  # a line per pair
            if searches[r["pair"]].settled(*r[1:]):
                lines[r["pair"]] = (searches.pop(r["pair"]).slope, *r[1:])
    else:
        raise RuntimeError(f"slopes of {len(searches)} pairs did not settle")
    table = spark.createDataFrame([(p, *line) for p, line in lines.items()], _LINES)
    held = corners.join(F.broadcast(table), "pair", "left").withColumnRenamed("pair", "_pair")
    inside = F.col("wl").isNotNull() & (F.col("w") > F.col("wl")) & (F.col("w") <= F.col("wr"))
    kept = held.filter(~inside).select(F.col("_pair").alias("chain"), "x0", "x1", "w", "s", "dw", "ds")
    bridge = held.filter(inside).groupBy(F.col("_pair").alias("chain")).agg(
        F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.max("w").alias("w"), F.max_by("s", "w").alias("s"), F.sum("dw").alias("dw"), F.sum("ds").alias("ds"))
    return materialise(kept.unionByName(bridge), "chains")


def isotonic_blocks(rows: DataFrame, score: str, label: str, weight: str | None = None) -> DataFrame:
    """Stored rows (x0, x1, value, w): the blocks of the non-decreasing fit, from score x0 to x1. Rows without score or label are left out.

    Equal scores are one point. A constant score is one block; no rows give none.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    known = rows.select(F.col(score).cast("double").alias("x"), F.col(label).cast("double").alias("y"), w.alias("w")).dropna().filter("w > 0 AND NOT isnan(x)")
    points = known.groupBy("x").agg(F.sum("w").alias("dw"), F.sum(F.col("w") * F.col("y")).alias("ds"))
    chains = _chains(points)
    last = chains.agg(F.max("chain")).first()[0] or 0
    while last > 0:
        chains, last = _joined(chains), last // 2
    return chains.select("x0", "x1", (F.col("ds") / F.col("dw")).alias("value"), F.col("dw").alias("w"))


@dataclass(frozen=True)
class IsotonicMap:
    """A fitted map as a table of blocks; between blocks values are interpolated, outside they are those of the ends."""

    blocks: DataFrame

    def _ends(self) -> Broadcast:
        n = self.blocks.count()
        if n > MOST_BLOCKS:
            raise ValueError(f"the map has {n} blocks, more than the {MOST_BLOCKS} that are broadcast")
        table = self.blocks.orderBy("x0").toArrow()  # MOST_BLOCKS rows at most
        low, high, value = (table[c].to_numpy() for c in ("x0", "x1", "value"))
        return self.blocks.sparkSession.sparkContext.broadcast((np.stack([low, high], axis=1).ravel(), np.repeat(value, 2)))

    def applied(self, df: DataFrame, score: str, output: str) -> DataFrame:
        """``df`` with the mapped ``score``; NULL stays NULL, and a map without blocks maps to NULL."""
        shared = self._ends()

        @F.pandas_udf("double")
        def mapped(x: pd.Series) -> pd.Series:
            ends, values = shared.value
            known = x.notna()
            out = pd.Series(np.nan, index=x.index, dtype=float)
            if len(ends):
                out[known] = np.interp(x[known].to_numpy(float), ends, values)
            return out.astype("Float64").where(known & bool(len(ends)), None)

        return df.withColumn(output, mapped(F.col(score).cast("double")))


def fit_isotonic(rows: DataFrame, score: str, label: str, weight: str | None = None) -> IsotonicMap:
    return IsotonicMap(isotonic_blocks(rows, score, label, weight))
