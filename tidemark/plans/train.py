"""Dataset assembly, champion training and tuning."""

from __future__ import annotations

import copy
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.columns import in_hash_sample
from ..functions.telco import engineer_telco, fit_bill_cutoffs
from ..operators import models as m
from ..operators.caps import Caps, capped_pairs
from ..operators.metrics import evaluate_scores
from ..operators.splits import SplitSpec, assign
from ..operators.subscription import column_roles, fill_categories, model_frame
from ..session import materialise
from ..sources.sinks import stage, write_metadata, write_report_csv, write_test_artifacts
from ..sources.tables import path_exists, read_table


def sample_rows(df: DataFrame, id_col: str, fraction: float | None = None, max_rows: int | None = None, method: str = "xxhash64") -> DataFrame:
    """Repeatable fraction by id hash, then the first ``max_rows`` by id."""
    if fraction:
        df = df.filter(in_hash_sample(F.col(id_col), float(fraction), method))
    return df.orderBy(id_col).limit(int(max_rows)) if max_rows else df


def _split(df: DataFrame, cfg: dict, label: str, id_col: str, dataset: str) -> DataFrame:
    date_col = "latest_transaction_date" if dataset == "subscription" else "transaction_date"
    return assign(df, SplitSpec.configured(cfg.get("split", {}), dataset, date_col=date_col), label, id_col)


def _fit_rows(parts: DataFrame, data: dict) -> DataFrame:
    return parts if data.get("fit_on", "train") == "all" else parts.filter("split = 'train'")


def assemble_dataset(df: DataFrame, cfg: dict, source: str = "") -> m.Dataset:
    """Sample, split, engineer and assign roles. The split comes before dates are dropped.

    Telco bill cut-offs and the caps of subscription columns are fitted on the training rows (``cfg['data']['fit_on'] = 'all'`` fits
    them on every row) and belong to the run. The frame is stored once: every fit and every evaluation reads it.
    """
    data = cfg["data"]
    dataset = data.get("dataset_type", "telco").lower()
    id_col = data.get("id_col") or ("msno" if dataset == "subscription" else "customerID")
    df = sample_rows(df, id_col, data.get("sample_frac"), data.get("max_rows"))

    if dataset == "subscription":
        label = data.get("target_col", "is_churn")
        if label not in df.columns:
            raise ValueError(f"target column '{label}' is missing")
        parts, caps = _split(df, cfg, label, id_col, dataset), None
        if columns := capped_pairs(df):
            parts = materialise(parts, "parts")
            caps = Caps.fitted(_fit_rows(parts, data), columns)
            parts = caps.applied(parts)
        keep = parts.withColumn("_id", F.col(id_col))
        frame = model_frame(keep, label, id_col).withColumnRenamed("_id", id_col)
        extra = {}
    else:
        if "Churn" not in df.columns:
            raise ValueError("target column 'Churn' is missing")
        label = "ChurnFlag"
        labelled = df.withColumn(label, F.when(F.lower("Churn") == "yes", 1).otherwise(0))
        parts = _split(labelled, cfg, label, id_col, dataset)
        cut, caps = fit_bill_cutoffs(_fit_rows(parts, data)).first(), None
        frame = engineer_telco(parts, (cut["p75"], cut["median"])).drop("Churn")
        extra = {"p75": cut["p75"], "median": cut["median"]}
    numeric, categorical = column_roles(frame, exclude=(label, id_col, "split"))
    stored = materialise(fill_categories(frame, categorical), "dataset")
    return m.Dataset(stored, numeric, categorical, label, id_col, source, extra, caps)


def load_dataset(spark: SparkSession, cfg: dict) -> m.Dataset:
    path = cfg["data"].get("feature_path") or cfg["data"].get("raw_path")
    if not path:
        raise ValueError("config must name data.feature_path or data.raw_path")
    return assemble_dataset(read_table(spark, path), cfg, path)


def apply_tuned_params(spark: SparkSession, cfg: dict, directory: str) -> dict:
    """The config with the best tuned parameters merged into its model section, if there are any."""
    cfg = copy.deepcopy(cfg)
    algorithm = cfg.get("tuning", {}).get("algorithm")
    path = f"{directory}/tuning/best_{algorithm}_params.json"
    if algorithm and path_exists(spark, path):
        best = spark.read.schema("best_params map<string,double>").json(path).first()["best_params"] or {}
        cfg.setdefault("models", {}).setdefault(algorithm, {}).update(best)
    return cfg


def tune(spark: SparkSession, data: m.Dataset, cfg: dict, directory: str, space: dict | None = None) -> dict:
    """Random search; writes the trial table and the best parameters; returns the best trial.

    Every trial is committed below ``directory`` when it ends, so a search that was stopped goes on with those that are missing.
    """
    t = cfg.get("tuning", {})
    algorithm = t.get("algorithm", "boosted_shallow")
    split = m.prepare_split(data)
    try:
        trials, best = m.random_search(
            split, algorithm, int(t.get("n_trials", 30)), t.get("objective_metric", "roc_auc"),
            cfg.get("split", {}).get("random_state", 42), space, t.get("parallel"), f"{directory}/tuning",
        )
    finally:
        split.release()
    write_report_csv(trials.withColumn("params", F.to_json("params")), f"{directory}/tuning/trials.csv")
    record = {
        "best_value": best["value"], "best_params": best["params"], "best_trial_number": best["number"],
        "objective_metric": best["objective_metric"], "best_threshold": best["threshold"],
        "roc_auc": best["roc_auc"], "pr_auc": best["pr_auc"], "f1": best["f1"],
    }
    write_metadata(
        spark.createDataFrame([record], "best_value double, best_params map<string,double>, best_trial_number int, "
                              "objective_metric string, best_threshold double, roc_auc double, pr_auc double, f1 double"),
        f"{directory}/tuning/best_{algorithm}_params.json",
    )
    return best


METADATA_SCHEMA = (
    "champion_model string, threshold double, numeric_cols array<string>, categorical_cols array<string>, "
    "feature_columns array<string>, dataset_type string, data_source string, date_col string, train_end string, "
    "dev_end string, bill_p75 double, bill_median double, caps array<struct<column string, low double, high double>>, test_metrics struct<roc_auc double, pr_auc double, "
    "f1 double, precision double, recall double, threshold double, positive_rate double>"
)


CANDIDATE_SCHEMA = m.METRIC_SCHEMA


def _candidate_home(directory: str | None, name: str) -> str | None:
    return f"{directory}/candidates/{name}" if directory else None


def _candidate_row(spark: SparkSession, name: str, fitted, split: m.Split, directory: str | None, resume: bool) -> dict:
    """Measure one candidate on dev, ``fitted()`` being its model. With a directory, in which its model lies by then, its metric row is kept there and found again on ``resume``."""
    home = _candidate_home(directory, name)
    if not home:
        return m.dev_metrics(fitted(), split.dev, name)

    def build() -> DataFrame:
        return spark.createDataFrame([m.dev_metrics(fitted(), split.dev, name)], CANDIDATE_SCHEMA).coalesce(1)

    return stage(spark, f"{home}/metrics", build, resume).first().asDict()


def train_champion(spark: SparkSession, data: m.Dataset, cfg: dict, directory: str | None = None, resume: bool = False) -> dict:
    """Fit the candidates, pick by dev ROC-AUC, refit on train+dev, evaluate on test, save.

    The threshold is the one chosen on dev. Returns the champion's name, model, candidate table
    and test metric row. ``resume`` takes candidates that ``directory`` already has: only for a directory of this very data and config.

    Candidates are fitted and their models saved side by side, and beside them the rows of the refit are made ready; candidates are
    measured and committed in their order.
    """
    if directory:
        cfg = apply_tuned_params(spark, cfg, directory)
    seed, params = cfg.get("split", {}).get("random_state", 42), cfg.get("models", {})
    split = m.prepare_split(data)
    try:
        estimators = m.candidate_models(params, split.n_train, seed)
        estimators = {k: v for k, v in estimators.items() if k in cfg.get("candidates", estimators)}

        def fit(name: str):
            model = estimators[name].fit(m.weighted(split.train, params.get(name, {})))
            if directory:
                PipelineModel([*split.fitted.stages, model]).write().overwrite().save(f"{_candidate_home(directory, name)}/model")
            return model

        def refit_rows():
            seen = m.prepared(data.frame.filter("split in ('train', 'dev')"), data, split.ratio)
            fitted, n = m.fit_preprocessor(seen, data.numeric, data.categorical), seen.count()
            return fitted, n, m.stored_vectors(fitted.transform(seen), data, n)

        kept = [k for k in estimators if resume and directory and path_exists(spark, f"{_candidate_home(directory, k)}/metrics/_SUCCESS")]
        with m.side_by_side(spark, {**{k: partial(fit, k) for k in estimators if k not in kept}, "refit rows": refit_rows}) as fits:
            rows = [_candidate_row(spark, k, fits[k].get if k in fits else partial(fit, k), split, directory, resume) for k in estimators]
            fitted, n_seen, vectors = fits["refit rows"].get()
    finally:
        split.release()
    champion = min(rows, key=lambda r: (-r["roc_auc"], r["model_name"]))

    # The linear penalty belongs to the rows of this fit, not to those of the candidates'.
    final = m.candidate_models(params, n_seen, seed)[champion["model_name"]]
    ready = m.weighted(vectors, params.get(champion["model_name"], {}))
    model = PipelineModel([*fitted.stages, final.fit(ready)])
    candidates = m.candidate_table(spark, rows)
    test = data.frame.filter("split = 'test'")
    test_scored = m.scored(model, m.prepared(test, data)).select(m.LABEL, m.SCORE)
    test_metrics = evaluate_scores(test_scored, m.LABEL, m.SCORE, champion["threshold"])
    result = {
        "champion": champion["model_name"], "threshold": champion["threshold"], "model": model,
        "candidates": candidates, "test_metrics": test_metrics, "dev_metrics": {k: v for k, v in champion.items() if k != "model_name"},
    }
    if directory:
        save_run(spark, data, cfg, result, test, directory)
    return result


def save_run(spark: SparkSession, data: m.Dataset, cfg: dict, result: dict, test: DataFrame, directory: str) -> None:
    s = cfg.get("split", {})
    timed = "train_end" in s
    metadata = {
        "champion_model": result["champion"], "threshold": result["threshold"], "numeric_cols": data.numeric,
        "categorical_cols": data.categorical, "feature_columns": data.features,
        "dataset_type": cfg["data"].get("dataset_type", "telco"), "data_source": data.source,
        "date_col": s.get("date_col") if timed else None, "train_end": s.get("train_end"),
        "dev_end": s.get("dev_end") if timed else None, "bill_p75": data.extra.get("p75"),
        "bill_median": data.extra.get("median"), "caps": data.caps.rows if data.caps else None, "test_metrics": result["test_metrics"].first().asDict(),
    }
    write_metadata(spark.createDataFrame([metadata], METADATA_SCHEMA), f"{directory}/model_metadata.json")
    write_report_csv(result["candidates"], f"{directory}/candidate_model_results.csv")
    both = result["test_metrics"].select(F.lit(result["champion"]).alias("champion"), F.struct(*result["test_metrics"].columns).alias("test"))
    dev = F.struct(*[F.lit(v).alias(k) for k, v in result["dev_metrics"].items()])
    write_metadata(both.withColumn("dev", dev), f"{directory}/metrics.json")
    write_test_artifacts(test, data.id_col, directory)
    result["model"].write().overwrite().save(f"{directory}/model")


def load_run(spark: SparkSession, directory: str) -> tuple[PipelineModel, dict]:
    path = f"{directory}/model_metadata.json"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no model metadata at {path}; train first")
    row = spark.read.schema(METADATA_SCHEMA).json(path).first()
    return PipelineModel.load(f"{directory}/model"), row.asDict(recursive=True)
