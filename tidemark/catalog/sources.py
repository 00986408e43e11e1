"""Readers and writers, exercised as round trips through the shared folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.decisions import predicted_flag
from ..operators import causal as c
from ..operators import metrics as mt
from ..operators import subscription as sub
from ..operators.models import METRIC_SCHEMA, candidate_table
from ..operators.splits import SplitSpec, assign
from ..plans.causal_report import causal_report
from ..plans.feature_table import build_feature_table, recap
from ..session import fresh_path
from ..sources import sinks, tables
from .bindings import bind, cte
from .evaluation import CANDIDATES_SQL, _EVALUATED, metric_rows
from .experiments import UPLIFT_SQL, _TABLE_DOUBLES
from .registry import query, rounded, rounded_sql
from .splitting import stratified_sql
from .subscription import BASE_DOUBLES, BASE_SQL, CAPPED_DOUBLES, CAPPED_SQL, LOGS, MEMBERS, select, transactions_cte

_S = "WITH " + cte("b_scored")


def _csv(spark, sf, binding):
    path = fresh_path(spark, binding) + ".csv"
    bind(spark, sf, binding).write.option("header", True).csv(path)
    return path


@query("s1_labels_csv", "WITH " + cte("b_label") + "\nSELECT * FROM b_label")
def s1_labels_csv(spark, sf):
    return sub.clean_labels(tables.read_labels(spark, _csv(spark, sf, "b_label")))


@query("s2_members_csv", "WITH " + cte("b_members") + ",\n" + MEMBERS + "\nSELECT * FROM m_clean")
def s2_members_csv(spark, sf):
    return sub.clean_members(tables.read_members(spark, _csv(spark, sf, "b_members")))


@query("s3_transactions_csv", "WITH " + cte("b_transactions") + ",\n" + transactions_cte() + "\nSELECT * FROM t_clean")
def s3_transactions_csv(spark, sf):
    return sub.clean_transactions(tables.read_transactions(spark, _csv(spark, sf, "b_transactions")))


@query("s4_logs_csv", "WITH " + cte("b_logs") + ",\n" + LOGS + "\nSELECT * FROM l_clean")
def s4_logs_csv(spark, sf):
    return sub.clean_logs(tables.read_logs(spark, _csv(spark, sf, "b_logs")))


@query("s5_stage", "WITH " + cte("b_label") + "\nSELECT * FROM b_label")
def s5_stage(spark, sf):
    """The second call must reuse the first one's table."""
    path = fresh_path(spark, "stage")
    sinks.stage(spark, path, lambda: bind(spark, sf, "b_label"))
    return sinks.stage(spark, path, lambda: bind(spark, sf, "b_label").limit(0))


@query("s6_read_table", _S + "\nSELECT * FROM b_scored")
def s6_read_table(spark, sf):
    path = fresh_path(spark, "scored") + ".pq"
    bind(spark, sf, "b_scored").write.parquet(path)
    return tables.read_table(spark, path)


@query("s7_string_columns", "WITH " + cte("b_telco") + "\nSELECT customerID, OnlineSecurity, PaymentMethod, tenure FROM b_telco")
def s7_string_columns(spark, sf):
    return tables.normalise_strings(bind(spark, sf, "b_telco").select("customerID", "OnlineSecurity", "PaymentMethod", "tenure"))


def _feature_table(spark, sf):
    """The whole build from CSV files; returns (base table path, output path)."""
    base, output = fresh_path(spark, "base") + ".parquet", fresh_path(spark, "features") + ".parquet"
    inputs = [_csv(spark, sf, b) for b in ("b_label", "b_members", "b_transactions", "b_logs")]
    build_feature_table(spark, *inputs, output, base_output=base)
    return base, output


@query("s8_base_table", rounded_sql(select(BASE_SQL, "SELECT * FROM base"), BASE_DOUBLES))
def s8_base_table(spark, sf):
    return rounded(spark.read.parquet(_feature_table(spark, sf)[0]), BASE_DOUBLES)


@query("s9_feature_table", rounded_sql(select(CAPPED_SQL, "SELECT * FROM capped"), BASE_DOUBLES + CAPPED_DOUBLES))
def s9_feature_table(spark, sf):
    return rounded(spark.read.parquet(_feature_table(spark, sf)[1]), BASE_DOUBLES + CAPPED_DOUBLES)


@query("s10_recap", rounded_sql(select(CAPPED_SQL, f"SELECT msno, {', '.join(CAPPED_DOUBLES)} FROM capped"), CAPPED_DOUBLES))
def s10_recap(spark, sf):
    base, _ = _feature_table(spark, sf)
    return rounded(recap(spark, base, fresh_path(spark, "recapped")).select("msno", *CAPPED_DOUBLES), CAPPED_DOUBLES)


_SPEC = SplitSpec(dev=None)


@query("s11_split_tables", _S + stratified_sql(dev=False))
def s11_split_tables(spark, sf):
    train, test = sinks.split_paths(fresh_path(spark, "table") + ".parquet")
    sinks.write_split(assign(bind(spark, sf, "b_scored"), _SPEC, "y", "id"), train, test)
    parts = [spark.read.parquet(p).select("id", "y", F.lit(name).alias("split")) for name, p in (("train", train), ("test", test))]
    return parts[0].unionByName(parts[1])


@query("s12_split_existing", "WITH parts AS (" + _S + stratified_sql(dev=False) + ")\nSELECT id, y FROM parts WHERE split = 'test'")
def s12_split_existing(spark, sf):
    path = fresh_path(spark, "existing") + ".parquet"
    bind(spark, sf, "b_scored").write.parquet(path)
    for _ in range(2):  # the second call finds the parts and does nothing
        assert sinks.ensure_split(spark, path, _SPEC, "y", "id")
    return spark.read.parquet(sinks.split_paths(path)[1]).select("id", "y")


def _test_artifacts(spark, sf):
    directory = fresh_path(spark, "artifacts")
    parts = assign(bind(spark, sf, "b_scored"), _SPEC, "y", "id")
    sinks.write_test_artifacts(parts.filter("split = 'test'").drop("split"), "id", directory)
    return directory


@query("s13_test_artifacts", "WITH parts AS (" + _S + stratified_sql(dev=False) + ")\nSELECT CAST(id AS STRING) AS id, CAST(y AS STRING) AS y FROM parts WHERE split = 'test'")
def s13_test_artifacts(spark, sf):
    rows = spark.read.option("header", True).csv(f"{_test_artifacts(spark, sf)}/splits/test_set.csv")
    return rows.select("id", "y")


@query("s14_saved_split", "WITH parts AS (" + _S + stratified_sql(dev=False) + ")\nSELECT id AS row_id, id FROM parts WHERE split = 'test'")
def s14_saved_split(spark, sf):
    return tables.find_saved_split(spark, _test_artifacts(spark, sf))[1]


@query("s15_candidates_csv", rounded_sql(CANDIDATES_SQL, _EVALUATED))
def s15_candidates_csv(spark, sf):
    path = fresh_path(spark, "candidates") + ".csv"
    sinks.write_report_csv(candidate_table(spark, metric_rows(spark, sf)), path)
    return rounded(spark.read.schema(METRIC_SCHEMA).option("header", True).csv(path), _EVALUATED)


def _predictions(spark, sf):
    """Two scoring runs of the same customers, the later one with doubled scores."""
    path = fresh_path(spark, "predictions")
    for stamp, factor in (("2024-01-01 08:00:00", 1.0), ("2024-01-02 09:30:00", 2.0)):
        run = bind(spark, sf, "b_scored").select("id", (F.col("p") * factor).alias("p"), F.lit(stamp).cast("timestamp").alias("scored_at"))
        sinks.append_predictions(run, path)
    return path


@query("s16_prediction_sink", _S + "\nSELECT d AS scored_date, count(*) AS n FROM b_scored, (SELECT DATE '2024-01-01' AS d UNION ALL SELECT DATE '2024-01-02') days GROUP BY d")
def s16_prediction_sink(spark, sf):
    return spark.read.parquet(_predictions(spark, sf)).groupBy("scored_date").agg(F.count("*").alias("n"))


@query("s17_latest_predictions", _S + "\nSELECT id, p * 2 AS p FROM b_scored")
def s17_latest_predictions(spark, sf):
    return tables.read_latest_predictions(spark, _predictions(spark, sf)).select("id", "p")


@query("s18_causal_bundle", UPLIFT_SQL)
def s18_causal_bundle(spark, sf):
    directory = fresh_path(spark, "causal")
    sinks.write_causal_bundle(causal_report(bind(spark, sf, "b_experiment"), "id", score="score", budget=0.5), directory)
    schema = "bin int, n_records bigint, treated_rate double, control_rate double, uplift double, cumulative_uplift double, control_baseline double"
    return rounded(spark.read.schema(schema).option("header", True).csv(f"{directory}/uplift_table.csv"), _TABLE_DOUBLES)


@query("s19_optional_read", _S + "\nSELECT id, y FROM b_scored")
def s19_optional_read(spark, sf):
    path = fresh_path(spark, "optional") + ".parquet"
    bind(spark, sf, "b_scored").select("id", "y").write.parquet(path)
    absent = tables.read_optional(spark, path.replace(".parquet", "-absent.parquet"), "id bigint, y int")
    return tables.read_optional(spark, path, "id bigint, y int").unionByName(absent)


@query("s20_metadata_json", _S + "\nSELECT count(*) AS n, 0.3::DOUBLE AS threshold FROM b_scored")
def s20_metadata_json(spark, sf):
    path = fresh_path(spark, "metadata") + ".json"
    row = mt.threshold_metrics(bind(spark, sf, "b_scored"), "y", "p", 0.3).select("threshold")
    n = bind(spark, sf, "b_scored").agg(F.count("*")).scalar()
    sinks.write_metadata(row.withColumn("n", n), path)
    return spark.read.schema("n bigint, threshold double").json(path)


@query("s21_scored_csv", _S + "\nSELECT id, p, CAST(p >= 0.3 AS INT) AS predicted FROM b_scored")
def s21_scored_csv(spark, sf):
    path = fresh_path(spark, "scored") + ".csv"
    df = bind(spark, sf, "b_scored").select("id", "p", predicted_flag(F.col("p"), 0.3).alias("predicted"))
    sinks.write_scored_csv(df, path)
    return spark.read.schema("id bigint, p double, predicted int").option("header", True).csv(path)


@query("p19_default_report", rounded_sql(UPLIFT_SQL.replace("ORDER BY score DESC, id", "ORDER BY id"), _TABLE_DOUBLES))
def p19_default_report(spark, sf):
    """Without any known score column the report ranks by a constant."""
    df = bind(spark, sf, "b_experiment").drop("score")
    return rounded(causal_report(df, "id")["uplift_table"], _TABLE_DOUBLES)


@query("p24_contract", "WITH " + cte("b_experiment") + """
SELECT kind, accepted, CASE WHEN accepted THEN (SELECT count(*) FROM b_experiment) ELSE 0 END AS n FROM (VALUES
  ('same run', true), ('same folder, other slash', true), ('nothing asked', true), ('other type', false), ('other source', false),
  ('other date column', false), ('other last day', false), ('no treatment column', false)) contract(kind, accepted)""")
def p24_contract(spark, sf):
    """Per case of the run contract and of the required columns: whether it is accepted, and the rows it lets through."""
    from ..plans.score import check_contract

    trained = {"dataset_type": "telco", "data_source": f"{sf}/customer.parquet", "date_col": "day", "dev_end": "2001-06-01"}
    frame = bind(spark, sf, "b_experiment")
    cases = {
        "same run": ("telco", f"{sf}/customer.parquet", "day", "2001-06-01"), "same folder, other slash": ("telco", f"{sf}/customer.parquet/"),
        "nothing asked": ("telco",), "other type": ("subscription",), "other source": ("telco", f"{sf}/orders.parquet"),
        "other date column": ("telco", None, "month"), "other last day": ("telco", None, "day", "2001-07-01"), "no treatment column": None,
    }

    def rows(asked):
        try:
            if asked is None:
                return c.standardize_experiment(frame.drop("treatment"))
            check_contract(trained, *asked)
        except (ValueError, KeyError):
            return None
        return c.standardize_experiment(frame)

    found = {kind: rows(asked) for kind, asked in cases.items()}
    counted = [
        (spark.range(0).agg(F.lit(0).cast("bigint").alias("n")) if df is None else df.agg(F.count("*").alias("n"))).select(
            F.lit(kind).alias("kind"), F.lit(df is not None).alias("accepted"), "n")
        for kind, df in found.items()
    ]
    return reduce(DataFrame.unionByName, counted)
