import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from tidemark.operators import isotonic as iso


def _pool(points):
    """[(x0, x1, value)] of sorted (x, weight, weighted label): plain pooling of adjacent violators."""
    out = []
    for x, w, s in points:
        out.append([x, x, w, s])
        while len(out) > 1 and out[-2][3] * out[-1][2] >= out[-1][3] * out[-2][2]:
            b, a = out.pop(), out.pop()
            out.append([a[0], b[1], a[2] + b[2], a[3] + b[3]])
    return [(a, b, s / w) for a, b, w, s in out]


def _blocks(spark, rows, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        frame = spark.createDataFrame(rows, "x double, y double, w double")
        return [(r.x0, r.x1, r.value) for r in iso.isotonic_blocks(frame, "x", "y", "w").orderBy("x0").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def _expected(rows):
    sums = {}
    for x, y, w in rows:
        a, b = sums.get(x, (0.0, 0.0))
        sums[x] = (a + w, b + w * y)
    return _pool([(x, *sums[x]) for x in sorted(sums)])


def _made(kind, n=160):
    rng = np.random.default_rng(len(kind))
    x = np.round(rng.random(n), 2 if kind == "ties" else 9)
    y = {"rising": x, "falling": 1 - x, "constant": np.full(n, 0.5), "labels": (rng.random(n) < x).astype(float), "ties": (rng.random(n) < 0.5).astype(float),
         "low end": np.where(x > 0.9, 0.0, x), "valley": np.abs(x - 0.5), "steps": np.floor(4 * x)}[kind]
    return [(float(a), float(b), float(c)) for a, b, c in zip(x, y, rng.integers(1, 5, n))]


@pytest.mark.parametrize("kind", ["rising", "falling", "constant", "labels", "ties", "low end", "valley", "steps"])
def test_chains_join_to_the_pooled_blocks(spark, many_ranges, kind):
    """Seven ranges, so several rounds and an odd chain, whatever the slope of the labels."""
    rows = _made(kind)
    got, want = _blocks(spark, rows, 7), _expected(rows)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert [v for _, _, v in got] == pytest.approx([v for _, _, v in want])


def test_one_heavy_low_row_at_the_end_pools_everything_above_it(spark, many_ranges):
    rows = [(i / 100, i / 100, 1.0) for i in range(100)] + [(2.0, 0.0, 1e6)]
    assert _blocks(spark, rows, 6) == [(0.0, 0.0, 0.0), (0.01, 2.0, pytest.approx(49.5 / (1e6 + 99)))]


def test_constant_score_and_no_rows(spark, many_ranges):
    assert _blocks(spark, [(0.3, float(i % 2), 1.0) for i in range(50)], 4) == [(0.3, 0.3, 0.5)]
    assert _blocks(spark, [], 4) == []
    nothing = iso.IsotonicMap(iso.isotonic_blocks(spark.createDataFrame([], "x double, y double"), "x", "y"))
    assert nothing.applied(spark.createDataFrame([(0.5,)], "x double"), "x", "p").first().p is None


def test_maps_like_the_library(spark):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(_made("labels", 400))], "id int, x double, y double, w double")
    model = IsotonicRegression(labelCol="y", weightCol="w", featuresCol="x").fit(frame)
    asked = frame.select("x").union(spark.range(200).select((F.col("id") / 150 - 0.1).alias("x")))
    both = model.transform(iso.fit_isotonic(frame, "x", "y", "w").applied(asked, "x", "ours"))
    assert both.filter("abs(ours - prediction) > 1e-9").count() == 0 and both.count() == 600
    assert iso.fit_isotonic(frame, "x", "y", "w").applied(spark.createDataFrame([(None,)], "x double"), "x", "p").first().p is None


def test_nulls_and_weightless_rows_are_left_out(spark):
    rows = [(0.1, 0.0, 1.0), (0.2, 1.0, 1.0), (None, 1.0, 1.0), (0.3, None, 1.0), (0.05, 1.0, 0.0), (float("nan"), 1.0, 1.0)]
    assert _blocks(spark, rows, 3) == [(0.1, 0.1, 0.0), (0.2, 0.2, 1.0)]


def test_the_driver_sees_a_number_per_pair(spark, many_ranges, monkeypatch):
    """Of 2,000 distinct scores nothing but marks of pairs is collected while fitting."""
    from pyspark.sql.classic.dataframe import DataFrame

    sizes, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: sizes.append(len(out := collect(self))) or out)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    frame = spark.createDataFrame(_made("falling", 2000), "x double, y double, w double")
    iso.isotonic_blocks(frame, "x", "y", "w")
    assert sizes and max(sizes) <= 8
