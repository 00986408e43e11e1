"""Classification metrics over the scored customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as mt
from ..operators.models import candidate_table
from ..operators.reporting import technical_summary
from .bindings import bind, cte
from .registry import query, rounded, rounded_sql

_S = "WITH " + cte("b_scored")
_CURVE = _S + """,
by_score AS (SELECT p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM b_scored GROUP BY p),
curve AS (SELECT p, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
 FROM by_score WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
areas AS (SELECT sum(CAST(neg * (tp - pos) + neg * pos / 2.0 AS DOUBLE)) / max(CAST(all_pos AS DOUBLE) * all_neg) AS roc_auc,
 sum(CAST(pos AS DOUBLE) / all_pos * (CAST(tp AS DOUBLE) / (tp + fp))) AS pr_auc FROM curve)"""


def _cells(t: str = "0.3") -> str:
    return (
        f"cells AS (SELECT count(*) FILTER (WHERE y = 1 AND p >= {t}) AS tp, count(*) FILTER (WHERE y = 0 AND p >= {t}) AS fp,"
        f" count(*) FILTER (WHERE y = 1 AND p < {t}) AS fn, count(*) FILTER (WHERE y = 0 AND p < {t}) AS tn FROM b_scored)"
    )


_PRF = "2.0 * tp / (2 * tp + fp + fn) AS f1, 1.0 * tp / (tp + fp) AS precision, 1.0 * tp / (tp + fn) AS recall"
_PRF_COLUMNS = ["f1", "precision", "recall"]


@query("a5_class_ratio", _S + "\nSELECT CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) / greatest(count(*) FILTER (WHERE y = 1), 1) AS class_ratio FROM b_scored")
def a5_class_ratio(spark, sf):
    return mt.class_ratio(bind(spark, sf, "b_scored"), "y")


def _flagged(spark, sf):
    return bind(spark, sf, "b_scored").withColumn("pred", (F.col("p") >= 0.3).cast("int"))


@query("a11_confusion", _S + ",\n" + _cells() + "\nSELECT * FROM (SELECT 0 AS actual, 0 AS predicted, tn AS n FROM cells UNION ALL SELECT 0, 1, fp FROM cells UNION ALL SELECT 1, 0, fn FROM cells UNION ALL SELECT 1, 1, tp FROM cells) x")
def a11_confusion(spark, sf):
    return mt.confusion_matrix(_flagged(spark, sf), "y", "pred")


@query("a12_threshold_metrics", rounded_sql(
    _S + ",\n" + _cells() + f"\n--SELECT\nSELECT {_PRF}, 0.3::DOUBLE AS threshold, 1.0 * (tp + fp) / (tp + fp + fn + tn) AS positive_rate FROM cells", _PRF_COLUMNS + ["positive_rate"]))
def a12_threshold_metrics(spark, sf):
    return rounded(mt.threshold_metrics(bind(spark, sf, "b_scored"), "y", "p", 0.3), _PRF_COLUMNS + ["positive_rate"])


_EVALUATED = _PRF_COLUMNS + ["positive_rate", "roc_auc", "pr_auc"]


@query("a12_evaluate_scores", rounded_sql(
    _CURVE + ",\n" + _cells() + f"\n--SELECT\nSELECT roc_auc, pr_auc, {_PRF}, 0.3::DOUBLE AS threshold, 1.0 * (tp + fp) / (tp + fp + fn + tn) AS positive_rate FROM cells, areas", _EVALUATED))
def a12_evaluate_scores(spark, sf):
    return rounded(mt.evaluate_scores(bind(spark, sf, "b_scored"), "y", "p", 0.3), _EVALUATED)


@query("a13_roc_auc", rounded_sql(_CURVE + "\n--SELECT\nSELECT roc_auc FROM areas", ["roc_auc"]))
def a13_roc_auc(spark, sf):
    return rounded(mt.roc_auc(bind(spark, sf, "b_scored"), "y", "p"), ["roc_auc"])


@query("a14_average_precision", rounded_sql(_CURVE + "\n--SELECT\nSELECT pr_auc FROM areas", ["pr_auc"]))
def a14_average_precision(spark, sf):
    return rounded(mt.average_precision(bind(spark, sf, "b_scored"), "y", "p"), ["pr_auc"])


@query("a15_roc_curve", rounded_sql(_CURVE + "\n--SELECT\nSELECT p AS threshold, CAST(fp AS DOUBLE) / all_neg AS fpr, CAST(tp AS DOUBLE) / all_pos AS tpr FROM curve UNION ALL SELECT NULL, 0, 0", ["fpr", "tpr"]))
def a15_roc_curve(spark, sf):
    return rounded(mt.roc_curve(bind(spark, sf, "b_scored"), "y", "p"), ["fpr", "tpr"])


@query("a16_pr_curve", rounded_sql(_CURVE + "\n--SELECT\nSELECT p AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / all_pos AS recall FROM curve UNION ALL SELECT NULL, 1, 0", ["precision", "recall"]))
def a16_pr_curve(spark, sf):
    return rounded(mt.precision_recall_curve(bind(spark, sf, "b_scored"), "y", "p"), ["precision", "recall"])


@query("w6_cumulative_counts", _CURVE + "\nSELECT p AS score, pos, neg, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(all_pos AS BIGINT) AS total_tp, CAST(all_neg AS BIGINT) AS total_fp FROM curve")
def w6_cumulative_counts(spark, sf):
    return mt.cumulative_counts(bind(spark, sf, "b_scored"), "y", "p")


_INNER = ", ".join(f"{i / 10}" for i in range(1, 10))


@query("a17_calibration", rounded_sql(
    _S + f"\n--SELECT\nSELECT CAST(len(list_filter([{_INNER}], lambda e: CAST(e AS DOUBLE) < p)) AS INT) AS bin, count(*) AS n, avg(p) AS mean_predicted, avg(y) AS fraction_positive FROM b_scored GROUP BY 1",
    ["mean_predicted", "fraction_positive"]))
def a17_calibration(spark, sf):
    return rounded(mt.calibration_table(bind(spark, sf, "b_scored"), "y", "p"), ["mean_predicted", "fraction_positive"])


_REPORT = _S + ",\n" + _cells() + """,
k AS (SELECT tn + fp AS s0, tp + fn AS s1, tn + fp + tp + fn AS n, 1.0 * tn / (tn + fn) AS p0, 1.0 * tn / (tn + fp) AS r0, 2.0 * tn / (2 * tn + fn + fp) AS f0,
 1.0 * tp / (tp + fp) AS p1, 1.0 * tp / (tp + fn) AS r1, 2.0 * tp / (2 * tp + fp + fn) AS f1, 1.0 * (tp + tn) / (tp + tn + fp + fn) AS acc FROM cells)
--SELECT
SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM k
UNION ALL SELECT '1', p1, r1, f1, s1 FROM k
UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM k
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM k
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM k"""


@query("a18_classification_report", rounded_sql(_REPORT, ["precision", "recall", "f1_score"]))
def a18_classification_report(spark, sf):
    return rounded(mt.classification_report(_flagged(spark, sf), "y", "pred"), ["precision", "recall", "f1_score"])


_SCAN = _S + """,
grid AS (SELECT 0.01::DOUBLE + CAST(k AS DOUBLE) * 0.01::DOUBLE AS threshold FROM range(99) r(k)),
scan AS (SELECT threshold, count(*) FILTER (WHERE y = 1 AND p >= threshold) AS tp, count(*) FILTER (WHERE y = 0 AND p >= threshold) AS fp,
 count(*) FILTER (WHERE y = 1 AND p < threshold) AS fn FROM b_scored, grid GROUP BY threshold),
metrics AS (SELECT threshold, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, coalesce(1.0 * tp / nullif(tp + fp, 0), 0) AS precision,
 coalesce(1.0 * tp / nullif(tp + fn, 0), 0) AS recall FROM scan)"""


@query("a19_threshold_scan", rounded_sql(_SCAN + "\n--SELECT\nSELECT * FROM metrics", _PRF_COLUMNS))
def a19_threshold_scan(spark, sf):
    return rounded(mt.threshold_scan(bind(spark, sf, "b_scored"), "y", "p"), _PRF_COLUMNS)


@query("a19_threshold", rounded_sql(_SCAN + "\n--SELECT\nSELECT * FROM metrics ORDER BY f1 DESC, threshold LIMIT 1", _PRF_COLUMNS))
def a19_threshold(spark, sf):
    return rounded(mt.choose_threshold(bind(spark, sf, "b_scored"), "y", "p"), _PRF_COLUMNS)


def metric_rows(spark, sf):
    """Metric rows of two scorers, the score and the charge, on the same customers."""
    df = bind(spark, sf, "b_scored")
    scorers = {"score": df, "charge": df.withColumn("p", F.col("MonthlyCharges") / 100)}
    return [
        {**mt.evaluate_scores(rows, "y", "p", 0.3).first().asDict(), "dev_best_f1_scan": 0.0, "model_name": name} for name, rows in scorers.items()
    ]


def _scorer_sql(name: str, value: str) -> str:
    inner = _CURVE + ",\n" + _cells() + f" SELECT '{name}' AS model_name, roc_auc, pr_auc, {_PRF}, 0.3::DOUBLE AS threshold, 1.0 * (tp + fp) / (tp + fp + fn + tn) AS positive_rate, 0.0::DOUBLE AS dev_best_f1_scan FROM cells, areas"
    return "(" + inner.replace(",\nby_score AS", f",\nsource AS (SELECT * REPLACE ({value} AS p) FROM b_scored),\nby_score AS").replace("FROM b_scored GROUP BY p", "FROM source GROUP BY p").replace("AS tn FROM b_scored", "AS tn FROM source") + ")"


CANDIDATES_SQL = "--SELECT\nSELECT * FROM " + _scorer_sql("score", "p") + " UNION ALL SELECT * FROM " + _scorer_sql("charge", "MonthlyCharges / 100")


@query("a20_candidates", rounded_sql(CANDIDATES_SQL, _EVALUATED))
def a20_candidates(spark, sf):
    return rounded(candidate_table(spark, metric_rows(spark, sf)), _EVALUATED)


@query("k4_ordered_champion", rounded_sql("--SELECT\nSELECT model_name, roc_auc FROM (" + CANDIDATES_SQL.replace("--SELECT\n", "") + ") c ORDER BY roc_auc DESC LIMIT 1", ["roc_auc"]))
def k4_ordered_champion(spark, sf):
    return rounded(candidate_table(spark, metric_rows(spark, sf)).limit(1).select("model_name", "roc_auc"), ["roc_auc"])


_TECHNICAL = ["roc_auc", "pr_auc", "f1", "precision", "recall"]


@query("a29_technical_summary", rounded_sql(_CURVE + ",\n" + _cells() + f"\n--SELECT\nSELECT roc_auc, pr_auc, {_PRF}, 0.3::DOUBLE AS threshold FROM cells, areas", _TECHNICAL))
def a29_technical_summary(spark, sf):
    return rounded(technical_summary(mt.evaluate_scores(bind(spark, sf, "b_scored"), "y", "p", 0.3)), _TECHNICAL)
