"""Classification metrics over (label, score) rows.

Everything that depends on the score order starts from one groupBy on the score, so tied scores
collapse before any sort; the remaining distinct scores are ordered by the running-total helper.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ranking import with_running_totals


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives per positive (positives counted as at least 1)."""
    y = F.col(label)
    return df.agg(
        (F.count_if(y == 0) / F.greatest(F.count_if(y == 1), F.lit(1))).cast("double").alias("class_ratio")
    )


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    y = F.col(label)
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )


def cumulative_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score, descending: rows at the score, and tp/fp counted down to it."""
    return with_running_totals(
        score_counts(df, label, score), [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}
    )


def _auc() -> Column:
    # Each negative loses to the positives above it and shares its ties. Products of counts are
    # taken as doubles: at billions of rows they leave BIGINT.
    neg = F.col("neg").cast("double")
    wins = neg * (F.col("tp") - F.col("pos")) + neg * F.col("pos") / 2
    pairs = F.max("total_tp").cast("double") * F.max("total_fp")
    return F.try_divide(F.sum(wins), pairs)


def _average_precision() -> Column:
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return F.sum(F.col("pos") / F.nullif(F.col("total_tp"), F.lit(0)) * precision)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return cumulative_counts(df, label, score).agg(_auc().alias("roc_auc"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    return cumulative_counts(df, label, score).agg(_average_precision().alias("pr_auc"))


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score, plus the origin (NULL threshold)."""
    points = cumulative_counts(df, label, score).select(
        F.col("score").alias("threshold"),
        F.try_divide("fp", "total_fp").alias("fpr"),
        F.try_divide("tp", "total_tp").alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def precision_recall_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score, plus the end point precision 1, recall 0 (NULL threshold)."""
    points = cumulative_counts(df, label, score).select(
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "total_tp").alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def _threshold_metrics(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    return {
        "f1": _ratio(tp * 2.0, tp * 2 + fp + fn),
        "precision": _ratio(tp.cast("double"), tp + fp),
        "recall": _ratio(tp.cast("double"), tp + fn),
    }


def threshold_metrics(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """One row of F1, precision, recall and positive rate at ``score >= threshold``."""
    y, hit = F.col(label), F.col(score) >= threshold
    tp, fp = F.count_if(hit & (y == 1)), F.count_if(hit & (y == 0))
    fn = F.count_if(~hit & (y == 1))
    return df.agg(
        *[v.alias(k) for k, v in _threshold_metrics(tp, fp, fn).items()],
        F.lit(float(threshold)).alias("threshold"),
        F.avg(hit.cast("int")).alias("positive_rate"),
    )


def evaluate_scores(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """The full metric row, ranking and threshold metrics, from one ordered pass."""
    hit = F.col("score") >= threshold
    tp, fp = F.sum(F.when(hit, F.col("pos")).otherwise(0)), F.sum(F.when(hit, F.col("neg")).otherwise(0))
    fn = F.sum("pos") - tp
    return cumulative_counts(df, label, score).agg(
        _auc().alias("roc_auc"),
        _average_precision().alias("pr_auc"),
        *[v.alias(k) for k, v in _threshold_metrics(tp, fp, fn).items()],
        F.lit(float(threshold)).alias("threshold"),
        _ratio((tp + fp).cast("double"), F.sum(F.col("pos") + F.col("neg"))).alias("positive_rate"),
    )


# ---------------------------------------------------------------- confusion and report


def _confusion_row(df: DataFrame, label: str, predicted: str) -> DataFrame:
    y, p = F.col(label), F.col(predicted)
    return df.agg(*[
        F.count_if((y == a) & (p == b)).alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)
    ])


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """All four (actual, predicted) cells, zero counts included."""
    cells = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"n{a}{b}").alias("n"))
        for a in (0, 1) for b in (0, 1)
    ])
    return _confusion_row(df, label, predicted).select(F.inline(cells))


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Rows '0', '1', 'accuracy', 'macro avg', 'weighted avg' of precision, recall, F1, support."""
    c = F.col
    counts = _confusion_row(df, label, predicted)
    total = c("n00") + c("n01") + c("n10") + c("n11")
    per_class = {}
    for k in (0, 1):
        o = 1 - k
        per_class[k] = {
            "precision": _ratio(c(f"n{k}{k}").cast("double"), c(f"n{k}{k}") + c(f"n{o}{k}")),
            "recall": _ratio(c(f"n{k}{k}").cast("double"), c(f"n{k}{k}") + c(f"n{k}{o}")),
            "f1_score": _ratio(c(f"n{k}{k}") * 2.0, c(f"n{k}{k}") * 2 + c(f"n{o}{k}") + c(f"n{k}{o}")),
            "support": c(f"n{k}0") + c(f"n{k}1"),
        }
    names = ("precision", "recall", "f1_score")
    accuracy = _ratio((c("n00") + c("n11")).cast("double"), total)

    def line(name: str, values: dict[str, Column]) -> Column:
        return F.struct(F.lit(name).alias("label"), *[values[n].cast("double").alias(n) for n in names],
                        values["support"].cast("bigint").alias("support"))

    macro = {n: (per_class[0][n] + per_class[1][n]) / 2 for n in names} | {"support": total}
    weighted = {
        n: _ratio(per_class[0][n] * per_class[0]["support"] + per_class[1][n] * per_class[1]["support"], total)
        for n in names
    } | {"support": total}
    rows = [
        line("0", per_class[0]), line("1", per_class[1]),
        line("accuracy", {n: accuracy for n in names} | {"support": total}),
        line("macro avg", macro), line("weighted avg", weighted),
    ]
    return counts.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- calibration and threshold scan


def calibration_table(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Right-closed uniform bins over [0, 1]; empty bins do not appear."""
    inner_edges = [i / bins for i in range(1, bins)]
    which = sum([(F.col(score) > edge).cast("int") for edge in inner_edges], F.lit(0))
    return df.groupBy(which.alias("bin")).agg(
        F.count("*").alias("n"),
        F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("fraction_positive"),
    )


def threshold_grid(step: float) -> list[float]:
    return [step + k * step for k in range(math.ceil((1.0 - step) / step))]


def threshold_scan(df: DataFrame, label: str, score: str, metric: str = "f1", step: float = 0.01) -> DataFrame:
    """F1 at every grid threshold. One groupBy onto grid cells; the rest is over ~1/step rows."""
    if metric != "f1":
        raise ValueError(f"unsupported metric: {metric}")
    grid = threshold_grid(step)
    m = len(grid)
    cells = F.array(*map(F.lit, grid))
    s = F.col(score)
    # How many grid values are <= the score: a guess by division, corrected against the grid.
    guess = F.greatest(F.least(F.floor(s / step).cast("int") - 2, F.lit(m)), F.lit(0))
    reached = guess + sum([F.coalesce(s >= F.get(cells, guess + k), F.lit(False)).cast("int") for k in range(4)], F.lit(0))
    y = F.col(label)
    cell_counts = df.filter(s.isNotNull()).groupBy(reached.alias("reached")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )
    all_cells = df.sparkSession.range(m + 1).select(F.col("id").cast("int").alias("reached"))
    filled = all_cells.join(cell_counts, "reached", "left").fillna(0, ["pos", "neg"])
    upward = Window.orderBy(F.col("reached").desc()).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    scanned = filled.select(
        "reached",
        F.sum("pos").over(upward).alias("tp"),
        F.sum("neg").over(upward).alias("fp"),
        F.sum("pos").over(everything).alias("positives"),
    ).filter(F.col("reached") >= 1)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("positives") - F.col("tp")
    return scanned.select(
        F.get(cells, F.col("reached") - 1).alias("threshold"),
        *[v.alias(k) for k, v in _threshold_metrics(tp, fp, fn).items()],
    )


def choose_threshold(df: DataFrame, label: str, score: str, metric: str = "f1", step: float = 0.01) -> DataFrame:
    """One row: the threshold of the best F1; the lowest one on ties."""
    return threshold_scan(df, label, score, metric, step).orderBy(F.desc("f1"), F.asc("threshold")).limit(1)
