"""Exploratory profiles: column summaries, rates per category, histograms, correlations."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F

from .quantiles import exact_quantiles
from .subscription import column_roles


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value as text) rows for several columns at once."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.*")


def null_counts(df: DataFrame) -> DataFrame:
    """(column, missing_count) for every column, from one aggregate."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_count")) for c in df.columns])
    return counted.select(F.inline(rows))


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, missing, distinct, moments, most frequent value.

    Value counts come from one groupBy on (column, value), so no task holds a whole column. The
    most frequent value is shown as text; the smallest value in the column's own order wins ties.
    """
    numeric, other = column_roles(df)
    types = dict(df.dtypes)

    counts = _long(df, df.columns).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    # Ties go to the smallest value: numerically for numeric columns, else as text.
    as_number = F.when(F.col("column").isin(*numeric), F.col("value").try_cast("double")) if numeric else F.lit(None).cast("double")
    highest = counts.groupBy("column").agg(F.max("n").alias("top_freq"), F.count("*").alias("unique_values"))
    tops = (
        counts.join(F.broadcast(highest), "column")  # one row per column
        .filter(F.col("n") == F.col("top_freq"))
        .withColumn("number", as_number)
        .groupBy("column")
        .agg(
            F.first("unique_values").alias("unique_values"),
            F.first("top_freq").alias("top_freq"),
            F.min("number").alias("number"),
            F.min("value").alias("text"),
            F.min_by("value", "number").alias("number_text"),
        )
        .select("column", "unique_values", "top_freq", F.coalesce("number_text", "text").alias("top_value"))
    )

    n = F.count  # non-null rows
    def skew(c: Column) -> Column:
        m = n(c).cast("double")
        return F.when(m > 2, F.skewness(c) * F.sqrt(m * (m - 1)) / (m - 2))

    def describe(name: str) -> Column:
        c = F.col(name)
        stats = {
            "missing_count": F.count_if(c.isNull()),
            "missing_pct": F.round(F.count_if(c.isNull()) / F.count("*") * 100, 2),
        }
        value = c.cast("double")
        moments = {"mean": F.avg(value), "std": F.stddev_samp(value), "min": F.min(value), "max": F.max(value), "skew": skew(value)}
        stats |= {k: v if name in numeric else F.lit(None).cast("double") for k, v in moments.items()}
        return F.struct(F.lit(name).alias("column"), F.lit(types[name]).alias("dtype"), *[v.alias(k) for k, v in stats.items()]).alias(name)

    described = df.agg(*[describe(name) for name in df.columns]).select(F.inline(F.array(*df.columns)))
    kind = (
        F.when(F.col("column").isin(*numeric), "numeric") if numeric else F.when(F.lit(False), "numeric")
    ).when(F.coalesce("unique_values", F.lit(0)) <= 10, "categorical").otherwise("high_cardinality")
    return (
        described.join(F.broadcast(tops), "column", "left")  # one row per column
        .withColumn("unique_values", F.coalesce("unique_values", F.lit(0).cast("bigint")))
        .withColumn("feature_type", kind)
        .orderBy(F.desc("missing_pct"), "column")
    )


def rate_by_category(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Mean label per value of each column, NULL kept as a value, highest rate first."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return (
        df.select(F.explode(pairs).alias("p"), F.col(label).cast("double").alias("y"))
        .groupBy("p.column", "p.value")
        .agg(F.avg("y").alias("rate"), F.count("*").alias("n"))
        .orderBy("column", F.desc("rate"), F.asc("value"))
    )


def counts_by_category(df: DataFrame, columns: list[str], label: str | None = None) -> DataFrame:
    """Row counts per value of each column, split by label when one is given."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    keys = ["p.column", "p.value"] + ([label] if label else [])
    kept = df.select(F.explode(pairs).alias("p"), *([F.col(label)] if label else []))
    return kept.groupBy(*keys).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None) -> DataFrame:
    """Counts per equal-width bin over the column's range; the maximum falls in the last bin."""
    value, lo, hi = F.col("_value"), F.col("_ends.lo"), F.col("_ends.hi")
    ends = df.agg(F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).alias("ends"))
    index = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((value - lo) * bins / F.nullif(hi - lo, F.lit(0.0))), F.lit(bins - 1))
    ).cast("int")
    keys = [F.col(by)] if by else []
    edges = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), ends.scalar().alias("_ends"))
    edges = edges.select("bin", (lo + F.col("bin") * (hi - lo) / bins).alias("bin_start"), (lo + (F.col("bin") + 1) * (hi - lo) / bins).alias("bin_end"))
    counts = (
        df.filter(F.col(column).isNotNull())
        .withColumns({"_value": F.col(column).cast("double"), "_ends": ends.scalar()})
        .groupBy(*keys, index.alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    return counts.join(F.broadcast(edges), "bin")  # one row per bin


def describe_columns(df: DataFrame, columns: list[str], percentiles: list[float] = (0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """One row per column: count, mean, std, min, exact percentiles, max."""
    percentiles = list(percentiles)
    stats = df.agg(*[
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(F.col(c).cast("double")).alias("mean"),
            F.stddev_samp(c).alias("std"), F.min(F.col(c).cast("double")).alias("min"), F.max(F.col(c).cast("double")).alias("max"),
        ).alias(c) for c in columns
    ]).select(F.inline(F.array(*columns)))
    names = [f"p{p * 100:g}" for p in percentiles]
    quantiles = exact_quantiles(df, columns, percentiles).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(c)[i].alias(n) for i, n in enumerate(names)]) for c in columns
    ])))
    return stats.join(F.broadcast(quantiles), "column")  # one row per column


def box_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles and 1.5 IQR fences per column."""
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(c)[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]) for c in columns
    ])))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    return q.withColumns({"lower_fence": F.col("q1") - reach, "upper_fence": F.col("q3") + reach})


def outlier_share(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Share of rows below ``low``, above ``high``, and NULL once outliers count as missing."""
    c = F.col(column)
    return df.agg(
        F.avg(F.coalesce(c < low, F.lit(False)).cast("int")).alias("share_below"),
        F.avg(F.coalesce(c > high, F.lit(False)).cast("int")).alias("share_above"),
        F.avg((~F.coalesce(c.between(low, high), F.lit(False))).cast("int")).alias("share_missing_after"),
    )


def outliers_to_null(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column).between(low, high), F.col(column)))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair, from one aggregate over half the matrix."""
    halves = list(combinations_with_replacement(columns, 2))
    one_row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in halves])
    cells = [(a, b, f"{a}|{b}") for a, b in halves] + [(b, a, f"{a}|{b}") for a, b in halves if a != b]
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"`{key}`").alias("correlation")) for a, b, key in cells
    ])))


def daily_total(df: DataFrame, date: str, value: str) -> DataFrame:
    return df.groupBy(date).agg(F.sum(value).alias("total"))


def date_range(df: DataFrame, date: str) -> DataFrame:
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


LISTENER_METRICS = ["songs_played", "total_secs", "completion_rate", "skip_rate", "repeat_ratio"]


def user_profile(metrics: DataFrame) -> DataFrame:
    """Mean daily listening metrics per user."""
    return metrics.groupBy("msno").agg(*[F.avg(m).alias(m) for m in LISTENER_METRICS])


def time_series(df: DataFrame, key: str, value, order: str) -> DataFrame:
    """All rows of one key in time order (the filter reaches the scan)."""
    return df.filter(F.col(key) == value).orderBy(order)
