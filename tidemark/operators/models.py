"""MLlib pipelines: preprocessing, candidate classifiers, search, uplift pairs, calibration, clusters."""

from __future__ import annotations

import hashlib
import json
import math
import random
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import SEARCH_SPACE
from ..session import materialise
from ..sources.sinks import stage
from .boosting import BoostedTrees
from .caps import Caps
from .isotonic import IsotonicMap, fit_isotonic
from .metrics import choose_threshold, evaluate_scores
from .profile import LISTENER_METRICS
from .quantiles import exact_quantiles

LABEL, WEIGHT, SCORE = "label", "weight", "churn_probability"
#: Distinct values of all categorical columns together that a model may have.
MOST_CATEGORIES = 1_000_000
#: Rows of feature vectors that a task fits on.
ROWS_PER_TASK = 50_000


@dataclass(frozen=True)
class Dataset:
    """One frame (label, id and ``split`` stay in it) with the roles of its feature columns."""

    frame: DataFrame
    numeric: list[str]
    categorical: list[str]
    label: str
    id_col: str
    source: str = ""
    extra: dict = field(default_factory=dict)
    caps: Caps | None = None

    @property
    def features(self) -> list[str]:
        return self.numeric + self.categorical


# ---------------------------------------------------------------- preprocessing


def _computed(columns: dict[str, str]) -> SQLTransformer:
    return SQLTransformer(statement="SELECT *, " + ", ".join(f"{sql} AS `{name}`" for name, sql in columns.items()) + " FROM __THIS__")


def category_labels(df: DataFrame, columns: list[str], limit: int = MOST_CATEGORIES) -> dict[str, list[str]]:
    """The distinct values of each column in alphabetical order: the dictionary of a model.

    They are found and counted by Spark in one pass, and come to the driver, as part of the model, only within ``limit``; more are an error.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(columns)])
    distinct = materialise(df.select(F.explode(pairs).alias("p")).select("p.column", "p.value").filter("value IS NOT NULL").distinct(), "categories")
    if (n := distinct.count()) > limit:
        most = distinct.groupBy("column").count().orderBy(F.desc("count")).first()
        raise ValueError(f"{n} distinct categories, more than {limit}; {columns[most['column']]} alone has {most['count']}")
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in distinct.orderBy("column", "value").collect():  # `limit` at most
        out[columns[r["column"]]].append(r["value"])
    return out


def indexer(labels: dict[str, list[str]], columns: list[str], outputs: list[str]) -> StringIndexerModel:
    """One stage for all columns, as each stage of a pipeline is saved and loaded by jobs of its own. An array per column has the column's own
    length; ``from_arrays_of_labels`` fills the shorter ones up with nulls."""
    gateway = SparkContext._gateway
    text = gateway.jvm.java.lang.String
    arrays = gateway.new_array(text, len(columns), 0)
    for i, c in enumerate(columns):
        arrays[i] = JavaWrapper._new_java_array(labels[c], text)
    model = StringIndexerModel._create_from_java_class("org.apache.spark.ml.feature.StringIndexerModel", arrays)
    return model.setInputCols(columns).setOutputCols(outputs).setHandleInvalid("keep")


def fit_preprocessor(df: DataFrame, numeric: list[str], categorical: list[str]) -> PipelineModel:
    """Median-impute and standardise numbers; one-hot categories (unknown ones become all zeros).

    Medians are exact and deviations those of the population; a constant column becomes 0. ``df`` is read several times.
    """
    fitted, stages, parts = [], [], []
    if numeric:
        medians = exact_quantiles(df, numeric, [0.5]).first()
        fill = _computed({f"{c}__filled": f"coalesce(nanvl(`{c}`, NULL), {float((medians[c] or [0])[0] or 0)!r}D)" for c in numeric})
        filled = fill.transform(df).agg(*[f(f"`{c}__filled`") for c in numeric for f in (F.avg, F.stddev_pop)]).first()
        scale = {}
        for i, c in enumerate(numeric):
            mean, deviation = filled[2 * i] or 0.0, filled[2 * i + 1] or 0.0
            scale[f"{c}__scaled"] = f"(`{c}__filled` - {mean!r}D) / {deviation!r}D" if deviation else f"`{c}__filled` * 0D"
        fitted += [fill, _computed(scale), VectorAssembler(inputCols=list(scale), outputCol="_scaled")]
        parts.append("_scaled")
    if categorical:
        indexed, hot = [f"{c}__index" for c in categorical], [f"{c}__hot" for c in categorical]
        labels = category_labels(df, categorical)
        stages += [
            indexer(labels, categorical, indexed),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        ]
        parts += hot
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return PipelineModel([*fitted, *Pipeline(stages=stages).fit(df if not fitted else PipelineModel(fitted).transform(df)).stages])


def feature_names(fitted: PipelineModel) -> list[str]:
    """Names of the assembled vector slots: num__<column>, cat__<column>_<category>."""
    names: list[str] = []
    for stage in fitted.stages:
        if isinstance(stage, VectorAssembler) and stage.getOutputCol() == "_scaled":
            names += [f"num__{c.removesuffix('__scaled')}" for c in stage.getInputCols()]
        elif stage.__class__.__name__ == "StringIndexerModel":
            for column, labels in zip(stage.getInputCols(), stage.labelsArray):
                names += [f"cat__{column}_{value}" for value in labels]
    return names


def prepared(df: DataFrame, data: Dataset, ratio: float = 1.0) -> DataFrame:
    """Numbers as DOUBLE, the label as DOUBLE, and a weight that balances the classes."""
    y = F.col(data.label).cast("double")
    return df.withColumns({
        **{c: F.col(c).cast("double") for c in data.numeric},
        LABEL: y,
        WEIGHT: F.when(y == 1, float(ratio)).otherwise(1.0),
    })


def weighted(rows: DataFrame, params: dict) -> DataFrame:
    """``rows`` of ``prepared`` with the positive class's weight from the parameters, if they have one."""
    if "scale_pos_weight" not in params:
        return rows
    return rows.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, float(params["scale_pos_weight"])).otherwise(1.0))


# ---------------------------------------------------------------- estimators


def logistic(n_rows: int, max_iter: int = 2000, weight: str | None = None) -> LogisticRegression:
    """L2 logistic regression; the penalty matches an inverse strength of 1 over summed losses."""
    model = LogisticRegression(
        labelCol=LABEL, featuresCol="features", maxIter=max_iter, regParam=1.0 / max(n_rows, 1),
        elasticNetParam=0.0, standardization=False, tol=1e-10,
    )
    return model.setWeightCol(weight) if weight else model


def _tree_depth(params: dict) -> int:
    depth = int(params.get("max_depth", 5))
    if depth <= 0:  # unlimited depth is bounded by the leaf count
        depth = math.ceil(math.log2(int(params.get("num_leaves", 31))))
    return min(depth, 30)


def boosted_trees(params: dict, seed: int = 42) -> BoostedTrees:
    """Gradient-boosted trees from the common parameter names."""
    leaf_rows = params.get("min_child_samples", params.get("min_child_weight", 1))
    return BoostedTrees(
        labelCol=LABEL, featuresCol="features", weightCol=WEIGHT, seed=seed,
        maxIter=int(params.get("n_estimators", 400)),
        stepSize=float(params.get("learning_rate", 0.05)),
        maxDepth=_tree_depth(params),
        subsamplingRate=float(params.get("subsample", 0.9)),
        featureSubsetStrategy=str(float(params.get("colsample_bytree", 0.9))),
        minInstancesPerNode=max(int(leaf_rows), 1),
        minInfoGain=float(params.get("gamma", 0.0)),
    )


def candidate_models(models: dict, n_rows: int, seed: int = 42) -> dict:
    """The three candidates: logistic regression and two boosted-tree presets."""
    shallow = {"max_depth": 4, "min_child_weight": 1, **models.get("boosted_shallow", {})}
    leafy = {"max_depth": -1, "num_leaves": 31, "min_child_samples": 20, **models.get("boosted_leafy", {})}
    return {
        "logistic_regression": logistic(n_rows, models.get("logistic_regression", {}).get("max_iter", 2000)),
        "boosted_shallow": boosted_trees(shallow, seed),
        "boosted_leafy": boosted_trees(leafy, seed),
    }


def scored(model, df: DataFrame, output: str = SCORE) -> DataFrame:
    """Add the positive-class probability; the intermediate vectors are dropped."""
    out = model.transform(df)
    extra = [c for c in out.columns if c not in df.columns and c != "probability"]
    return out.withColumn(output, vector_to_array("probability")[1]).drop("probability", *extra)


def penalised_gradient(model, rows: DataFrame) -> DataFrame:
    """Rows (slot, gradient, size) of an unweighted linear model's loss over ``rows``, with its penalty; slot -1 is the intercept, ``size`` the
    root mean square of the slot's values. At the optimum of ``logistic`` every gradient is 0.

    Tasks add up their rows, so one row per slot and task is exchanged.
    """
    residual = scored(model, rows).select((F.col(SCORE) - F.col(LABEL)).alias("r"), vector_to_array("features").alias("x"))
    slots = F.concat(F.array(F.struct(F.lit(-1).alias("slot"), F.lit(1.0).alias("x"))), F.transform("x", lambda x, i: F.struct(i.alias("slot"), x.alias("x"))))
    sums = residual.select("r", F.explode(slots).alias("s")).groupBy("s.slot").agg(F.avg(F.col("r") * F.col("s.x")).alias("loss"), F.sqrt(F.avg(F.col("s.x") ** 2)).alias("size"))
    weights = F.array(F.lit(0.0), *[F.lit(float(w)) for w in model.coefficients])
    return sums.select("slot", (F.col("loss") + model.getRegParam() * F.get(weights, F.col("slot") + 1)).alias("gradient"), "size")


def is_stationary(model, rows: DataFrame, tolerance: float = 1e-4) -> bool:
    """Whether ``model`` is the optimum over ``rows``: no slot's gradient exceeds ``tolerance`` of the slot's size."""
    return penalised_gradient(model, rows).filter(F.abs("gradient") > tolerance * F.col("size")).isEmpty()


# ---------------------------------------------------------------- train, compare, search


@contextmanager
def side_by_side(spark, work: dict[str, Callable[[], object]]):
    """Begins every piece of ``work``, each in a thread and a scheduler pool of its own, and gives {name: its result to come}.

    What still runs at the end, also after an error, is cancelled and waited for.
    """
    context, mark = spark.sparkContext, f"side-by-side-{uuid.uuid4().hex}"

    def begin(name: str):
        context.setLocalProperty("spark.scheduler.pool", f"fit-{name}")
        context.addJobTag(mark)
        return work[name]()

    pool = ThreadPool(max(len(work), 1))
    running = {name: pool.apply_async(begin, (name,)) for name in work}
    try:
        yield running
    finally:
        while not all(r.ready() for r in running.values()):  # between two of its jobs a fit has none to cancel
            context.cancelJobsWithTag(mark)
            time.sleep(0.05)
        pool.terminate()


@dataclass(frozen=True)
class Split:
    """Preprocessed train and dev rows, kept in memory or on disk while models are fitted."""

    fitted: PipelineModel
    train: DataFrame
    dev: DataFrame
    n_train: int
    ratio: float

    def release(self) -> None:
        self.train.unpersist()
        self.dev.unpersist()


def label_balance(df: DataFrame, label: str) -> tuple[int, float]:
    """(rows, negatives per positive)."""
    y = F.col(label)
    row = df.agg(F.count("*"), F.count_if(y == 0), F.count_if(y == 1)).first()
    return row[0], row[1] / max(row[2], 1)


def stored_vectors(ready: DataFrame, data: Dataset, n: int) -> DataFrame:
    """A stored narrow table of what fitting needs, read in partitions of about ROWS_PER_TASK rows.

    Trees take a job per level, so partitions that hold few rows cost more than they spread. The stored files are compact and can
    be few however many rows they have, so rows of more than one task are dealt out.
    """
    narrow = materialise(ready.select(data.id_col, "split", LABEL, WEIGHT, "features"), "vectors")
    return in_tasks(narrow, n)


def in_tasks(df: DataFrame, n: int) -> DataFrame:
    """``df``, which has about ``n`` rows, in partitions of about ROWS_PER_TASK rows."""
    tasks = max(1, math.ceil(n / ROWS_PER_TASK))
    return df.coalesce(1) if tasks == 1 else df.repartition(tasks)


def prepare_split(data: Dataset) -> Split:
    n, ratio = label_balance(data.frame.filter("split = 'train'"), data.label)
    rows = prepared(data.frame, data, ratio)
    fitted = fit_preprocessor(rows.filter("split = 'train'"), data.numeric, data.categorical)
    ready = stored_vectors(fitted.transform(rows), data, n)
    return Split(fitted, ready.filter("split = 'train'").persist(), ready.filter("split = 'dev'").persist(), n, ratio)


def dev_metrics(model, dev: DataFrame, name: str) -> dict:
    """Threshold chosen on dev by F1, and the metric row at it. Only these numbers reach the driver."""
    rows = scored(model, dev).select(LABEL, SCORE)
    best = choose_threshold(rows, LABEL, SCORE).first()
    row = evaluate_scores(rows, LABEL, SCORE, best["threshold"]).first().asDict()
    return {**row, "dev_best_f1_scan": best["f1"], "model_name": name}


METRIC_SCHEMA = (
    "roc_auc double, pr_auc double, f1 double, precision double, recall double, threshold double, "
    "positive_rate double, dev_best_f1_scan double, model_name string"
)


def candidate_table(spark, rows: list[dict]) -> DataFrame:
    """Candidate metrics, best ROC-AUC first: the first row is the champion."""
    return spark.createDataFrame(rows, METRIC_SCHEMA).orderBy(F.desc("roc_auc"), "model_name")


def draw_params(space: dict, rng: random.Random) -> dict:
    def draw(kind, low, high):
        if kind == "int":
            return rng.randint(low, high)
        if kind == "log":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.uniform(low, high)

    return {name: draw(*spec) for name, spec in space.items()}


TRIAL_SCHEMA = "number int, value double, params map<string,double>, threshold double, roc_auc double, pr_auc double, f1 double"


def frame_digest(df: DataFrame) -> str:
    """Of the rows, in whatever order: their number and the sum of their hashes."""
    n, total = df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return f"{n}-{total or 0}"


def random_search(split: Split, algorithm: str, n_trials: int = 30, objective: str = "roc_auc", seed: int = 42,
                  space: dict | None = None, parallel: int | None = None, directory: str | None = None) -> tuple[DataFrame, dict]:
    """Random search over boosted-tree parameters: (trial table, best trial).

    Rows are preprocessed once; trials share them and run ``parallel`` at a time (unless given, as many as there are cores for), each in a
    scheduler pool of its own, so that under fair scheduling none waits behind another's jobs. With a ``directory`` each trial commits its row to the trial table of
    this data, space and seed as it ends; a search that is begun again, also with more trials, fits only those that the table has not got.
    """
    if algorithm not in SEARCH_SPACE:
        raise ValueError(f"algorithm must be one of {sorted(SEARCH_SPACE)}")
    rng, spark = random.Random(seed), split.train.sparkSession
    parallel = parallel or max(2, spark.sparkContext.defaultParallelism)
    # The weight of the positive class is searched around the class ratio.
    weight = {"scale_pos_weight": ("float", max(0.5, split.ratio / 2), max(0.5, 2 * split.ratio))}
    ranges = {**SEARCH_SPACE[algorithm], **weight, **(space or {})}
    trials = [(i, draw_params(ranges, rng)) for i in range(n_trials)]
    home = None
    if directory:
        facts = [frame_digest(split.train.select(LABEL, vector_to_array("features"))), frame_digest(split.dev.select(LABEL, vector_to_array("features"))), algorithm, objective, seed, ranges]
        home = f"{directory}/trials-{hashlib.sha256(json.dumps(facts, sort_keys=True).encode()).hexdigest()[:16]}"

    def run(trial) -> dict:
        number, params = trial
        row = dev_metrics(boosted_trees(params, seed).fit(weighted(split.train, params)), split.dev, algorithm)
        return {"number": number, "value": row[objective], "params": {k: float(v) for k, v in params.items()},
                **{k: row[k] for k in ("threshold", "roc_auc", "pr_auc", "f1")}}

    def committed(trial) -> dict:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{trial[0] % parallel}")
        if home is None:
            return run(trial)
        done = stage(spark, f"{home}/number={trial[0]}", lambda: spark.createDataFrame([run(trial)], TRIAL_SCHEMA).drop("number").coalesce(1))
        return {"number": trial[0], **done.drop("number").first().asDict()}

    with ThreadPool(parallel) as pool:
        rows = pool.map(committed, trials, chunksize=1)
    best = max(rows, key=lambda r: (r["value"], -r["number"]))
    return spark.createDataFrame(rows, TRIAL_SCHEMA), {**best, "objective_metric": objective, "algorithm": algorithm}


# ---------------------------------------------------------------- importances


def global_importance(model, names: list[str], top_n: int = 30) -> list[tuple[str, float]]:
    """(feature, weight) of a fitted model without row-level attributions, largest first."""
    weights = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    pairs = [(n, abs(float(w))) for n, w in zip(names, weights.toArray())]
    return sorted(pairs, key=lambda p: (-p[1], p[0]))[:top_n]


def importance_table(spark, model, names: list[str], top_n: int = 20, value: str = "importance") -> DataFrame:
    return spark.createDataFrame(global_importance(model, names, top_n), f"feature string, {value} double")


# ---------------------------------------------------------------- uplift pair


def two_model_uplift(df: DataFrame, features: list[str], treatment: str = "treatment", outcome: str = "outcome") -> tuple[DataFrame, PipelineModel, PipelineModel]:
    """Add ``uplift_score``: P(outcome | treated model) - P(outcome | control model), on the same row."""
    missing = sorted({treatment, outcome} - set(df.columns))
    if missing:
        raise KeyError(f"missing required column(s): {', '.join(missing)}")
    rows = df.withColumns({**{c: F.col(c).cast("double") for c in features}, LABEL: F.col(outcome).cast("double")})

    def fit(arm: DataFrame) -> PipelineModel:
        return Pipeline(stages=[
            VectorAssembler(inputCols=features, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="features", withMean=False, withStd=True),
            logistic(arm.count(), max_iter=500),
        ]).fit(arm)

    treated = fit(rows.filter(F.col(treatment) == 1))
    control = fit(rows.filter(F.col(treatment) != 1))
    both = scored(control, scored(treated, rows, "_p_treated"), "_p_control")
    out = both.withColumn("uplift_score", F.col("_p_treated") - F.col("_p_control"))
    return out.drop("_p_treated", "_p_control", LABEL), treated, control


# ---------------------------------------------------------------- calibration


def fold_of(id_col: str, folds: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(folds))


def fit_isotonic_folds(ready: DataFrame, estimator, id_col: str, folds: int = 3, penalty_rows: int | None = None) -> list[tuple[Model, IsotonicMap]]:
    """Per fold: the model fitted on the other folds and an isotonic map fitted on the fold itself.

    With ``penalty_rows`` the estimator's penalty is that of a fit on so many rows, and each fit gets that of its own.
    """
    fold, fitted = fold_of(id_col, folds), []
    for k in range(folds):
        others, own = ready.filter(fold != k), estimator
        if penalty_rows is not None:
            own = estimator.copy({estimator.regParam: estimator.getRegParam() * penalty_rows / max(others.count(), 1)})
        model = own.fit(others)
        fitted.append((model, fit_isotonic(scored(model, ready.filter(fold == k)), SCORE, LABEL)))
    return fitted


def calibrated(df: DataFrame, folds: list[tuple[Model, IsotonicMap]], output: str = "calibrated_probability") -> DataFrame:
    """Mean of the folds' calibrated probabilities."""
    names = []
    for k, (model, isotonic) in enumerate(folds):
        name = f"_fold{k}"
        df = isotonic.applied(scored(model, df), SCORE, name).drop(SCORE)
        names.append(name)
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    return df.withColumn(output, total / len(names)).drop(*names)


# ---------------------------------------------------------------- clusters


def cluster_listeners(profile: DataFrame, k: int = 5, seed: int = 42, columns: list[str] = LISTENER_METRICS) -> DataFrame:
    """Standardised K-means over the mean listening profile, until centres rest; adds ``cluster``."""
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="_raw", handleInvalid="skip"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster", maxIter=300, tol=1e-9),
    ])
    return pipeline.fit(profile).transform(profile).drop("_raw", "features")


def nearest_means(clustered: DataFrame, columns: list[str] = LISTENER_METRICS, slack: float = 1e-6) -> DataFrame:
    """``clustered`` with ``at_rest``: whether each row's own cluster mean is its nearest, distances in standard deviations, but for ``slack``."""
    deviations = clustered.agg(*[F.stddev_samp(c).alias(c) for c in columns]).first()
    means = clustered.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in columns]).collect()  # a row per cluster

    def distance(mean) -> Column:
        return sum((((F.col(c) - mean[c]) / (deviations[c] or 1.0)) ** 2 for c in columns), F.lit(0.0))

    own = F.coalesce(*[F.when(F.col("cluster") == m["cluster"], distance(m)) for m in means])
    return clustered.withColumn("at_rest", own <= F.least(*map(distance, means), F.lit(float("inf"))) + slack)
