"""MLlib queries. Model outputs have no SQL counterpart; their preprocessing does where exact."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F

from ..fixed_values import CAPPED_COLUMNS
from ..operators import models as m
from ..operators import subscription as sub
from ..operators.isotonic import fit_isotonic
from ..operators.explain import driver_columns, mean_absolute, tree_attributions
from ..operators.profile import user_profile
from ..operators.quantiles import add_capped_columns
from ..plans.runs import StoredRun, stored_run
from ..plans.score import features_for, score_batch
from ..plans.train import assemble_dataset, train_champion, tune
from ..session import fresh_path, materialise
from ..streaming.scoring import read_requests, start_scoring
from .bindings import bind, cte, table
from .registry import query, rounded, rounded_sql
from .splitting import stratified_sql
from .subscription import BASE_SQL, CAPPED_DOUBLES, LOGS, caps_cte, select
from .telco import FEATURES

#: All three candidates as declared: 2,000 iterations, 400 trees.
CONFIG = {"data": {"dataset_type": "telco"}, "split": {"train_size": 0.70, "dev_size": 0.15, "random_state": 42}}


def dataset(spark, sf) -> m.Dataset:
    return assemble_dataset(bind(spark, sf, "b_telco"), CONFIG, f"{sf}/customer.parquet")


def run(spark, sf) -> StoredRun:
    """The stored run of CONFIG, which all queries about trained models read."""
    return stored_run(spark, [f"{sf}/customer.parquet"], lambda: dataset(spark, sf), CONFIG)


def _fitted(spark, sf):
    """(dataset, preprocessor model, all rows with their feature vector)."""
    data = dataset(spark, sf)
    rows = m.prepared(data.frame, data)
    fitted = m.fit_preprocessor(rows.filter("split = 'train'"), data.numeric, data.categorical)
    return data, fitted, fitted.transform(rows).select(data.id_col, "split", m.LABEL, m.WEIGHT, "features")


def _stored(spark, sf):
    """All rows with their feature vector, stored and in tasks by rows, for queries that fit on them."""
    data, _, ready = _fitted(spark, sf)
    return m.stored_vectors(ready, data, data.frame.count())


def _vectors(spark, sf, model):
    """(customerID, label, features) of all customers under a stored pipeline."""
    _, metadata = run(spark, sf).load(spark)
    raw = bind(spark, sf, "b_telco").withColumn(m.LABEL, F.when(F.lower("Churn") == "yes", 1.0).otherwise(0.0))
    rows = features_for(raw, metadata["numeric_cols"], metadata["categorical_cols"], "telco", (metadata["bill_p75"], metadata["bill_median"]))
    return PipelineModel(model.stages[:-1]).transform(rows).select("customerID", m.LABEL, "features")


@query("m1_median_impute", "WITH " + cte("b_telco") + ", numbers AS (SELECT customerID, TRY_CAST(trim(TotalCharges) AS DOUBLE) AS x FROM b_telco)\nSELECT customerID, coalesce(x, (SELECT quantile_cont(x, 0.5) FROM numbers)) AS TotalCharges FROM numbers")
def m1_median_impute(spark, sf):
    df = bind(spark, sf, "b_telco").select("customerID", F.trim("TotalCharges").try_cast("double").alias("TotalCharges"))
    fitted = m.fit_preprocessor(df, ["TotalCharges"], [])
    return fitted.transform(df).select("customerID", F.col("TotalCharges__filled").alias("TotalCharges"))


@query("m2_standardise", rounded_sql("WITH " + cte("b_telco") + """
--SELECT
SELECT customerID, (MonthlyCharges - avg(MonthlyCharges) OVER ()) / stddev_pop(MonthlyCharges) OVER () AS charge, (tenure - avg(tenure) OVER ()) / stddev_pop(tenure) OVER () AS months FROM b_telco""", ["charge", "months"]))
def m2_standardise(spark, sf):
    df = bind(spark, sf, "b_telco").select("customerID", "MonthlyCharges", F.col("tenure").cast("double").alias("tenure"))
    out = m.fit_preprocessor(df, ["MonthlyCharges", "tenure"], []).transform(df).withColumn("x", vector_to_array("features"))
    return rounded(out.select("customerID", F.col("x")[0].alias("charge"), F.col("x")[1].alias("months")), ["charge", "months"])


@query("m3_one_hot", "WITH " + cte("b_telco") + "\nSELECT customerID, 'cat__Contract_' || Contract AS slot FROM b_telco UNION ALL SELECT customerID, 'cat__PaymentMethod_' || coalesce(PaymentMethod, '__missing__') FROM b_telco")
def m3_one_hot(spark, sf):
    df = sub.fill_categories(bind(spark, sf, "b_telco"), ["Contract", "PaymentMethod"])
    fitted = m.fit_preprocessor(df, [], ["Contract", "PaymentMethod"])
    names = F.array(*map(F.lit, m.feature_names(fitted)))
    out = fitted.transform(df).select("customerID", F.posexplode(vector_to_array("features")).alias("i", "hot"))
    return out.filter("hot > 0").select("customerID", F.get(names, F.col("i")).alias("slot"))


_NUMERIC = [
    "SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges", "avg_monthly_spend", "price_ratio", "revenue_risk_proxy", "is_month_to_month", "auto_pay",
    "electronic_check", "paperless", "num_services", "service_adoption_rate", "multi_service_customer", "has_support", "has_streaming", "fiber_customer",
    "senior_citizen", "high_bill", "low_tenure_high_bill", "high_value_long_tenure", "fiber_monthly", "month_to_month_no_support"]
_CATEGORICAL = [
    "gender", "Partner", "Dependents", "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod", "tenure_group", "customer_stage"]


_DRAWN, _, _SPLIT = stratified_sql(dev=True).rpartition("\nSELECT ")
_PARTS = f"b_scored AS (SELECT customerID AS id, CAST(lower(Churn) = 'yes' AS INT) AS y FROM b_telco){_DRAWN},\nparts_of AS (SELECT {_SPLIT})"


def _vector_sql() -> str:
    """Every slot that is not 0 of the vectors of all customers: medians, moments, categories and bill cut-offs are those of the training rows."""
    features = FEATURES.replace("q AS (SELECT", _PARTS + ",\nq AS (SELECT", 1).replace("0.5) AS med FROM b_telco)", "0.5) AS med FROM b_telco WHERE customerID IN (SELECT id FROM parts_of WHERE split = 'train'))", 1)
    numbers = " UNION ALL ".join(f"SELECT customerID, split, {i} AS part, CAST({c} AS DOUBLE) AS x FROM rows_of" for i, c in enumerate(_NUMERIC))
    values = " UNION ALL ".join(f"SELECT customerID, split, {i} AS part, coalesce(CAST({c} AS VARCHAR), '__missing__') AS v FROM rows_of" for i, c in enumerate(_CATEGORICAL))
    return f"""{features},
rows_of AS (SELECT f.*, p.split FROM features f JOIN parts_of p ON p.id = f.customerID),
numbers AS ({numbers}),
medians AS (SELECT part, coalesce(quantile_cont(x, 0.5), 0) AS m FROM numbers WHERE split = 'train' GROUP BY part),
filled AS (SELECT customerID, split, part, coalesce(x, m) AS x FROM numbers JOIN medians USING (part)),
moments AS (SELECT part, avg(x) AS mean, stddev_pop(x) AS dev FROM filled WHERE split = 'train' GROUP BY part),
cats AS ({values}),
known AS (SELECT part, v, {len(_NUMERIC)} - 1 + row_number() OVER (ORDER BY part, v) AS slot FROM (SELECT DISTINCT part, v FROM cats WHERE split = 'train'))
--SELECT
SELECT customerID, split, CAST(slot AS INT) AS slot, value FROM (
 SELECT customerID, split, part AS slot, CASE WHEN dev > 0 THEN (x - mean) / dev ELSE 0.0 END AS value FROM filled JOIN moments USING (part)
 UNION ALL SELECT customerID, split, slot, 1.0 FROM cats JOIN known USING (part, v)) slots WHERE abs(value) > 1e-9"""


@query("m4_preprocessor", rounded_sql(_vector_sql(), ["value"]))
def m4_preprocessor(spark, sf):
    """The whole vector of every customer, a row per slot that is not 0."""
    _, _, ready = _fitted(spark, sf)
    slots = ready.select("customerID", "split", F.posexplode(vector_to_array("features")).alias("slot", "value")).filter(F.abs("value") > 1e-9)
    return rounded(slots, ["value"])


@query("m5_logistic", "WITH " + cte("b_telco") + "\nSELECT customerID, CAST(lower(Churn) = 'yes' AS DOUBLE) AS label, true AS at_optimum, true AS is_probability FROM b_telco")
def m5_logistic(spark, sf):
    """Scores of all customers under a model that is the optimum of the training rows: every gradient of its loss and penalty there is 0."""
    ready = _stored(spark, sf)
    train = ready.filter("split = 'train'").persist()
    model = m.logistic(train.count()).fit(train)
    optimal = m.is_stationary(model, train)
    train.unpersist()
    return m.scored(model, ready).select("customerID", m.LABEL, F.lit(optimal).alias("at_optimum"), F.col(m.SCORE).between(0, 1).alias("is_probability"))


@query("m6_boosted_trees")
def m6_boosted_trees(spark, sf):
    """The run's shallow candidate, 400 trees of depth 4, over all customers."""
    model = run(spark, sf).candidate("boosted_shallow")
    return m.scored(model.stages[-1], _vectors(spark, sf, model)).select("customerID", m.LABEL, m.SCORE)


@query("m7_train_champion")
def m7_train_champion(spark, sf):
    return run(spark, sf).test_metrics(spark)


@query("m8_random_search")
def m8_random_search(spark, sf):
    """All 30 trials in the declared ranges."""
    split = m.prepare_split(dataset(spark, sf))
    try:
        trials, _ = m.random_search(split, "boosted_shallow")
    finally:
        split.release()
    return trials.withColumn("params", F.to_json("params"))


@query("m9_tuned_champion")
def m9_tuned_champion(spark, sf):
    """Tune by all 30 trials in the declared ranges, then train the three candidates with the tuned parameters merged into the config."""
    directory = fresh_path(spark, "tuned")
    cfg = {**CONFIG, "tuning": {"algorithm": "boosted_shallow"}}
    data = dataset(spark, sf)
    tune(spark, data, cfg, directory)
    return train_champion(spark, data, cfg, directory)["candidates"]


@query("m10_two_model_uplift", "WITH " + cte("b_experiment") + "\nSELECT id, treatment, true AS both_at_optimum FROM b_experiment")
def m10_two_model_uplift(spark, sf):
    """Both arms' models are the optima of their own rows: every gradient is 0 there. That the scores are theirs is j6."""
    rows = bind(spark, sf, "b_experiment")
    scored, *pair = m.two_model_uplift(rows, ["propensity", "score"])

    def optimal(model, arm) -> bool:
        labelled = arm.withColumn(m.LABEL, F.col("outcome").cast("double"))
        return m.is_stationary(model.stages[-1], PipelineModel(model.stages[:-1]).transform(labelled))

    both = all(optimal(model, rows.filter(F.col("treatment") == t)) for model, t in zip(pair, (1, 0)))
    return scored.select("id", "treatment", (F.lit(both) & F.col("uplift_score").between(-1, 1)).alias("both_at_optimum"))


@query("j6_uplift_alignment", "WITH " + cte("b_experiment") + "\nSELECT id, treatment, outcome, true AS from_own_row FROM b_experiment")
def j6_uplift_alignment(spark, sf):
    """Invariant: each row's uplift is the difference of both models' probabilities of that row, computed again from its own columns."""
    features = ["propensity", "score"]
    scored, *pair = m.two_model_uplift(bind(spark, sf, "b_experiment"), features)

    def probability(model) -> Column:
        _, scaler, final = model.stages
        weights = [float(w) / s if s else 0.0 for w, s in zip(final.coefficients, scaler.std)]
        margin = sum((F.col(c) * w for c, w in zip(features, weights)), F.lit(float(final.intercept)))
        return 1 / (1 + F.exp(-margin))

    again = probability(pair[0]) - probability(pair[1])
    return scored.select("id", "treatment", "outcome", (F.abs(F.col("uplift_score") - again) < 1e-9).alias("from_own_row"))


def _explained(spark, sf):
    """All customers under the better of the run's boosted candidates."""
    stored = run(spark, sf)
    name = stored.candidates(spark).filter("model_name <> 'logistic_regression'").first()["model_name"]
    model = stored.candidate(name)
    attributed, expected = tree_attributions(_vectors(spark, sf, model), model.stages[-1])
    return attributed, model.stages[-1], m.feature_names(model), expected


@query("m11_attributions", "WITH " + cte("b_telco") + "\nSELECT customerID, true AS adds_up, true AS largest_first FROM b_telco")
def m11_attributions(spark, sf):
    """Attributions of every customer: with the expected margin they add up to the log-odds of the model's own probability, and the drivers are the largest."""
    vectors, model, names, expected = _explained(spark, sf)
    out = driver_columns(m.scored(model, vectors), names)
    margin = F.log(F.col(m.SCORE) / (1 - F.col(m.SCORE)))
    total = F.aggregate("attributions", F.lit(float(expected)), lambda a, x: a + x)
    sizes = F.transform("attributions", F.abs)
    largest = F.get(F.array(*map(F.lit, names)), F.array_position(sizes, F.array_max(sizes)).cast("int") - 1)
    return out.select("customerID", (F.abs(total - margin) < 1e-6).alias("adds_up"), F.col("top_driver_1").startswith(largest).alias("largest_first"))


@query("a21_mean_attribution")
def a21_mean_attribution(spark, sf):
    attributed, _, names, _ = _explained(spark, sf)
    return mean_absolute(attributed, names)


@query("a22_importance")
def a22_importance(spark, sf):
    _, model, names, _ = _explained(spark, sf)
    return m.importance_table(spark, model, names)


@query("m12_dataset", "WITH " + cte("b_telco") + "\nSELECT customerID, tenure, Contract, CAST(Churn = 'Yes' AS INT) AS ChurnFlag FROM b_telco")
def m12_dataset(spark, sf):
    return dataset(spark, sf).frame.select("customerID", "tenure", "Contract", "ChurnFlag")


_DATES = {"strategy": "time", "train_end": "2001-03-01", "dev_end": "2001-06-01"}
_CAPS_CONFIG = {"data": {"dataset_type": "subscription"}, "split": _DATES}
_TRAINING_CAPS = (
    "parted AS (SELECT *, CASE WHEN latest_transaction_date > DATE '2001-06-01' THEN 'test' WHEN latest_transaction_date > DATE '2001-03-01' THEN 'dev' ELSE 'train' END AS split"
    " FROM base WHERE latest_transaction_date IS NOT NULL),\n"
    + caps_cte().replace("FROM base)", "FROM parted WHERE split = 'train')").replace("FROM base, ends", "FROM parted, ends"))


def _capped_features(spark, sf):
    """The feature table with the caps of all its rows, as the build writes it."""
    return add_capped_columns(materialise(sub.base_features(*(bind(spark, sf, b) for b in ("b_label", "b_members", "b_transactions", "b_logs"))), "base"))


def subscription_dataset(spark, sf) -> m.Dataset:
    return assemble_dataset(_capped_features(spark, sf), _CAPS_CONFIG, f"{sf}/customer.parquet")


@query("m12_training_caps", rounded_sql(select(BASE_SQL + ",\n" + _TRAINING_CAPS, f"SELECT msno, split, {', '.join(CAPPED_DOUBLES)} FROM capped"), CAPPED_DOUBLES))
def m12_training_caps(spark, sf):
    """Train, dev and test rows under the caps of the training rows alone."""
    return rounded(subscription_dataset(spark, sf).frame.select("msno", "split", *CAPPED_DOUBLES), CAPPED_DOUBLES)


@query("p14_fitted_caps", rounded_sql(select(BASE_SQL + ",\n" + _TRAINING_CAPS, " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c}_lo AS low, {c}_hi AS high FROM ends" for c in CAPPED_COLUMNS)), ["low", "high"]))
def p14_fitted_caps(spark, sf):
    """The caps as the table that is stored with the run."""
    return rounded(subscription_dataset(spark, sf).caps.table(spark), ["low", "high"])


@query("m13_saved_model")
def m13_saved_model(spark, sf):
    model, metadata = run(spark, sf).load(spark)
    return score_batch(bind(spark, sf, "b_telco"), model, metadata).select("customerID", "churn_probability")


@query("m14_batch_score")
def m14_batch_score(spark, sf):
    return score_batch(bind(spark, sf, "b_telco"), *run(spark, sf).load(spark))


@query("n10_kmeans", "WITH " + cte("b_logs") + ",\n" + LOGS + "\nSELECT DISTINCT msno, true AS at_rest, true AS in_range FROM l_clean")
def n10_kmeans(spark, sf):
    """Every listener's cluster: its mean is the nearest of the clusters' own means, so that a further round would move nobody."""
    logs = sub.add_daily_metrics(sub.clean_logs(bind(spark, sf, "b_logs")))
    clustered = m.cluster_listeners(materialise(user_profile(logs), "profile"))
    return m.nearest_means(clustered).select("msno", "at_rest", F.col("cluster").between(0, 4).alias("in_range"))


@query("n11_isotonic", f"WITH {cte('b_telco')}, {_PARTS}\nSELECT id AS customerID, CAST(y AS DOUBLE) AS label, true AS rises, true AS keeps_means, split FROM parts_of WHERE split = 'dev'")
def n11_isotonic(spark, sf):
    """Calibrated dev rows; every fold's map rises, and over its own fold its values have the mean of the labels."""
    ready = _stored(spark, sf)
    train = ready.filter("split = 'train'").persist()
    n = train.count()
    folds = m.fit_isotonic_folds(train, m.logistic(n), "customerID", penalty_rows=n)
    rises, keeps = True, True
    for k, (model, isotonic) in enumerate(folds):
        values = [r["value"] for r in isotonic.blocks.orderBy("x0").collect()]  # blocks, few
        rises &= all(a < b for a, b in zip(values, values[1:]))
        own = isotonic.applied(m.scored(model, train.filter(m.fold_of("customerID", len(folds)) == k)), m.SCORE, "value")
        keeps &= abs(own.agg(F.avg(F.col("value") - F.col(m.LABEL))).first()[0]) < 1e-9
    train.unpersist()
    out = m.calibrated(ready.filter("split = 'dev'"), folds)
    return out.select("customerID", m.LABEL, (F.lit(rises) & F.col("calibrated_probability").between(0, 1)).alias("rises"), F.lit(keeps).alias("keeps_means"), "split")


_SCORES = "WITH " + cte("b_scored") + """,
points AS (SELECT row_number() OVER (ORDER BY p) AS i, p, sum(y) AS s, count(*) AS n FROM b_scored GROUP BY p),
upto AS (SELECT i, p, sum(s) OVER (ORDER BY i) AS s, sum(n) OVER (ORDER BY i) AS n FROM points),
means AS (SELECT a.i AS i, b.i AS j, CAST(b.s - coalesce(z.s, 0) AS DOUBLE) / (b.n - coalesce(z.n, 0)) AS m FROM upto a LEFT JOIN upto z ON z.i = a.i - 1 JOIN upto b ON b.i >= a.i),
least AS (SELECT i, j, min(m) OVER (PARTITION BY i ORDER BY j DESC) AS m FROM means),
fit AS (SELECT j, max(m) AS value FROM least GROUP BY j)
--SELECT
SELECT p, value FROM fit JOIN upto ON upto.i = fit.j"""


@query("n11_isotonic_fit", rounded_sql(_SCORES, ["value"]))
def n11_isotonic_fit(spark, sf):
    """The isotonic fit of outcomes on scores, at every score: the greatest, over the starts before it, of the least mean up to an end behind it."""
    scores = bind(spark, sf, "b_scored").select("p", "y")
    return rounded(fit_isotonic(scores, "p", "y").applied(scores.select("p").distinct(), "p", "value"), ["value"])


@query("st1_stream", "WITH " + cte("b_telco") + "\nSELECT customerID AS customer_id, true AS as_in_batch, true AS as_predicted FROM b_telco")
def st1_stream(spark, sf):
    """The customer table read as a stream of requests, scored and appended to a table, whose rows are those of the batch."""
    model, metadata = run(spark, sf).load(spark)
    batch = score_batch(bind(spark, sf, "b_telco"), model, metadata, explain=False)
    source = table(spark, sf, "customer").schema
    stream = read_requests(spark, sf, source, "customer.parquet")
    requests = bind(spark, sf, "b_telco", customer=stream)
    output = fresh_path(spark, "responses")
    start_scoring(requests, model, metadata, output, fresh_path(spark, "stream-state")).awaitTermination()
    both = spark.read.parquet(output).join(batch.select(F.col("customerID").alias("customer_id"), F.col(m.SCORE).alias("_p"), F.col("predicted_churn").alias("_predicted")), "customer_id", "full")
    return both.select("customer_id", F.coalesce(F.abs(F.col(m.SCORE) - F.col("_p")) < 1e-9, F.lit(False)).alias("as_in_batch"),
                       F.coalesce(F.col("predicted_churn") == F.col("_predicted"), F.lit(False)).alias("as_predicted"))
