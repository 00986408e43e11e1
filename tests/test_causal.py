import pytest
from pyspark.sql import functions as F

from tidemark.operators import causal as c
from tidemark.operators.cuts import top_share
from tidemark.plans.causal_report import causal_report

ROWS = [
    (0, 1, 0, 0.90, "A"), (1, 1, 0, 0.80, "A"), (2, 1, 1, 0.70, "B"), (3, 0, 1, 0.60, "B"),
    (4, 0, 0, 0.55, "A"), (5, 0, 1, 0.50, "B"), (6, 1, 0, 0.45, "A"), (7, 0, 1, 0.40, "B"),
]


@pytest.fixture(scope="module")
def toy(spark):
    return spark.createDataFrame(ROWS, "id int, treatment int, outcome int, score double, segment string")


def test_ate(toy):
    row = c.estimate_ate(toy).first()
    assert (row.ate, row.treated_mean, row.control_mean, row.uplift_direction) == (-0.5, 0.25, 0.75, "improves")
    assert c.estimate_ate(toy, higher_is_better=True).first().uplift_direction == "worsens"


def test_cate_orders_by_size_and_drops_null_segments(spark):
    rows = [(1, 1.0, "A"), (0, 0.0, "A"), (1, 0.0, "B"), (0, 0.25, "B"), (1, 1.0, None), (0, 0.0, None), (1, 1.0, "C")]
    df = spark.createDataFrame(rows, "treatment int, outcome double, segment string")
    out = c.estimate_cate(df, "segment").collect()
    assert [(r.segment, r.ate) for r in out] == [("A", 1.0), ("B", -0.25), ("C", None)]


def test_uplift_table(toy):
    rows = c.uplift_table(toy, bins=4).orderBy("bin").collect()
    assert [r.n_records for r in rows] == [2, 2, 2, 2]
    assert [(r.treated_rate, r.control_rate) for r in rows] == [(0, 0), (1, 1), (0, 0.5), (0, 1)]
    assert [r.cumulative_uplift for r in rows] == [0, 0, -0.5, -1.5]
    assert {r.control_baseline for r in rows} == {0.75}


def test_policy(toy):
    rows = c.recommend_policy(c.uplift_table(toy, bins=4), 1.0, 5.0, 0.5).orderBy("bin").collect()
    assert [r.treat for r in rows] == [True, True, False, False]
    assert [r.expected_gain for r in rows] == [-2, -2, 0, 0]
    assert [r.cumulative_gain for r in rows] == [-2, -4, -4, -4]


def test_policy_of_ten_single_row_bins(spark):
    uplift = [0.0, 0.0, -1.0, -1.0, 0.0, -1.0, 0.0, -1.0, 0.0, -1.0]
    table = spark.createDataFrame([(i, 1, u) for i, u in enumerate(uplift)], "bin int, n_records bigint, uplift double")
    rows = c.recommend_policy(table, 1.0, 5.0, 0.5).orderBy("bin").collect()
    assert [r.treat for r in rows] == [True] * 5 + [False] * 5
    assert [r.cumulative_gain for r in rows] == [-1, -2, -8, -14, -15, -15, -15, -15, -15, -15]
    only = c.recommend_policy(table, 1.0, 5.0, 0.5, only_positive=True)
    assert only.filter("treat").count() == 0


def test_quantile_bin_sizes(spark):
    df = spark.range(10).withColumn("score", -F.col("id").cast("double"))
    sizes = c.score_bins(df, "score", "id", 4).groupBy("bin").count().orderBy("bin").collect()
    assert [r["count"] for r in sizes] == [3, 2, 2, 3]
    one = c.score_bins(df.limit(1), "score", "id", 4).collect()
    assert [r.bin for r in one] == [0]


def test_cuts_through_ties_and_nulls(spark):
    """A constant score, nulls and a repeated score are cut by id, in the same places as a full sort."""
    df = spark.range(997).selectExpr("id", "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 3 = 0 THEN 0.5D ELSE (id * 37 % 211) / 211D END AS score").repartition(5)
    pdf = df.toPandas().sort_values(["score", "id"], ascending=[False, True], na_position="last").reset_index(drop=True)
    for share in (0.001, 0.3, 0.5, 0.79, 0.9, 1.0):
        assert sorted(r.id for r in top_share(df, "score", "id", share).collect()) == sorted(pdf.id[: max(1, int(997 * share))])
    got = {r.id: r.bin for r in c.score_bins(df, "score", "id", 7).collect()}
    assert [got[i] for i in pdf.id] == [max((rank * 7 + 995) // 996 - 1, 0) for rank in range(997)]
    constant = df.withColumn("score", F.lit(1.0))
    assert sorted(r.id for r in top_share(constant, "score", "id", 0.1).collect()) == list(range(99))


def test_top_share(toy):
    assert sorted(r.id for r in top_share(toy, "score", "id", 0.25).collect()) == [0, 1]
    assert top_share(toy, "score", "id", 0.01).count() == 1


def test_report_and_missing_columns(toy):
    bundle = causal_report(toy, "id", score="score", budget=0.5)
    row = bundle["summary"].first()
    assert (row.ate, row.budget_fraction) == (-0.5, 0.5)
    with pytest.raises(KeyError):
        c.estimate_ate(toy.drop("outcome"))
    with pytest.raises(KeyError):
        c.inverse_propensity_weights(toy)


def test_weights_are_clipped(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 1.0), (1, 0.5)], "treatment int, propensity double")
    assert [round(r.ipw, 6) for r in c.inverse_propensity_weights(df).collect()] == [1000.0, 1000.0, 2.0]
