"""Order-dependent operators against brute force, on inputs where one key holds a third of the rows."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles, ranking
from tidemark.operators import subscription as sub
from tidemark.operators.metrics import cumulative_counts, evaluate_scores


def raw_transactions(n=3000, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{rng.randrange(60)}"
        day = pd.Timestamp("2016-01-01") + pd.Timedelta(days=rng.randrange(120))
        expire = None if rng.random() < 0.15 else (day + pd.Timedelta(days=rng.choice([-3, 0, 7, 30]))).strftime("%Y%m%d")
        price = rng.choice(["99", "149", "1788", "-1", "x"])
        paid = rng.choice(["99", "149", "0", None])
        rows.append((user, str(rng.choice([-1, 3, 41])), rng.choice(["30", "7", "9999"]), price, paid, rng.choice(["0", "1", "2"]), day.strftime("%Y%m%d"), expire, rng.choice(["0", "1"])))
    rows += rows[:40]  # exact copies
    return rows


COLUMNS = ["msno", "payment_method_id", "payment_plan_days", "plan_list_price", "actual_amount_paid", "is_auto_renew", "transaction_date", "membership_expire_date", "is_cancel"]


@pytest.fixture(scope="module")
def transactions(spark):
    raw = spark.createDataFrame(raw_transactions(), ", ".join(f"{c} string" for c in COLUMNS)).repartition(6)
    return sub.clean_transactions(raw)


@pytest.fixture(scope="module")
def ordered(transactions):
    """The cleaned rows in pandas, in the operator's total order, with predecessors."""
    pdf = transactions.withColumn("o", sub._transaction_order()).toPandas()
    pdf = pdf.sort_values(["msno", "transaction_date", "o"], kind="stable")
    pdf["prev_day"] = pdf.groupby("msno")["transaction_date"].shift()
    pdf["prev_expire"] = pdf.groupby("msno")["membership_expire_date"].shift()
    return pdf


def _days(a, b):
    return [None if x is None or y is None or pd.isna(x) or pd.isna(y) else (y - x).days for x, y in zip(a, b)]


def test_transaction_features_match_brute_force(transactions, ordered):
    got = {r.msno: r for r in sub.transaction_features(transactions).collect()}
    assert set(got) == set(ordered.msno)
    for user, g in ordered.groupby("msno"):
        row = got[user]
        between = [x for x in _days(g.prev_day, g.transaction_date) if x is not None]
        gaps = [x for x in _days(g.prev_expire, g.transaction_date) if x is not None]
        assert row.txn_count == len(g)
        assert row.avg_days_between_transactions == pytest.approx(np.mean(between)) if between else row.avg_days_between_transactions is None
        assert row.avg_gap_from_prev_expire_to_txn == pytest.approx(np.mean(gaps)) if gaps else row.avg_gap_from_prev_expire_to_txn is None
        assert row.post_expiry_renewal_count == sum(x > 0 for x in gaps)
        assert row.early_renewal_count == sum(x <= 0 for x in gaps)
        assert row.latest_transaction_date == g.transaction_date.iloc[-1]
        last = g.iloc[-1]
        for name in ("plan_list_price", "actual_amount_paid", "membership_expire_date", "is_cancel"):
            a, b = row[f"latest_{name}"], last[name]
            assert (a is None and pd.isna(b)) or a == b
        ratios = (g.actual_amount_paid / g.plan_list_price)[g.plan_list_price > 0].dropna()
        assert row.avg_paid_to_list_ratio == (pytest.approx(ratios.mean()) if len(ratios) else None)


def test_lag_crosses_ranges(transactions, ordered, many_ranges):
    got = sub.with_previous_transaction(transactions)
    key = ["msno", "transaction_date", "membership_expire_date", "plan_list_price", "actual_amount_paid"]
    ours = sorted((tuple(str(r[c]) for c in (*key, "prev_transaction_date", "prev_expire_date")) for r in got.collect()))
    expected = sorted(
        tuple(str(None if pd.isna(v) else v) for v in row) for row in ordered[[*key, "prev_day", "prev_expire"]].itertuples(index=False)
    )
    assert ours == expected


def test_latest_log_and_features(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"u{i % 40}", f"2017{1 + (i // 28) % 12:02d}{1 + i % 28:02d}", *[str(rng.randrange(9)) for _ in range(6)], str(rng.randrange(90000))) for i in range(2000)]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ("msno", "date", "num_25", "num_50", "num_75", "num_985", "num_100", "num_unq", "total_secs")))
    scored = sub.add_daily_metrics(sub.clean_logs(raw))
    pdf = scored.toPandas()
    got = {r.msno: r for r in sub.log_features(scored).collect()}
    for user, g in pdf.groupby("msno"):
        row = got[user]
        assert row.log_day_count == len(g)
        assert row.total_secs_std == pytest.approx(g.total_secs.std())
        assert row.quality_score_avg == pytest.approx(g.quality_score.mean())
        newest = g[g.log_date == g.log_date.max()]
        # one whole row, not a mix of rows
        assert ((newest.total_secs == row.latest_total_secs) & (newest.songs_played == row.latest_songs_played) & (newest.num_unq == row.latest_num_unq)).any()


@pytest.fixture(scope="module")
def hot_scores(spark):
    rng = random.Random(5)
    rows = [(i, 0.5 if i % 3 == 0 else round(rng.random(), 3), int(rng.random() < 0.3)) for i in range(4000)]
    return spark.createDataFrame(rows, "id int, score double, y int").repartition(7)


def test_global_rank(hot_scores, many_ranges):
    got = ranking.with_global_rank(hot_scores, [F.col("score").desc(), F.col("id").asc()]).toPandas()
    expected = hot_scores.toPandas().sort_values(["score", "id"], ascending=[False, True]).id.tolist()
    assert got.sort_values("rank").id.tolist() == expected
    assert got["rank"].tolist() != [] and set(got.total) == {4000}


def test_rank_of_constant_score(spark, many_ranges):
    df = spark.range(3000).withColumn("score", F.lit(1.0))
    got = ranking.with_global_rank(df, [F.col("score").desc(), F.col("id").asc()]).toPandas()
    assert (got["rank"] == got["id"]).all()


def test_running_totals_and_metrics(hot_scores, many_ranges):
    pdf = hot_scores.toPandas()
    by = pdf.groupby("score").y.agg(["sum", "count"]).sort_index(ascending=False)
    got = cumulative_counts(hot_scores, "y", "score").toPandas().sort_values("score", ascending=False)
    assert got.tp.tolist() == by["sum"].cumsum().tolist()
    assert got.fp.tolist() == (by["count"] - by["sum"]).cumsum().tolist()
    row = evaluate_scores(hot_scores, "y", "score", 0.4).first()
    pos, neg = pdf.score[pdf.y == 1].to_numpy(), pdf.score[pdf.y == 0].to_numpy()
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert row.roc_auc == pytest.approx(auc)
    precision = by["sum"].cumsum() / by["count"].cumsum()
    assert row.pr_auc == pytest.approx((by["sum"] / by["sum"].sum() * precision).sum())
    assert row.positive_rate == pytest.approx((pdf.score >= 0.4).mean())


@pytest.mark.parametrize("slack", [0.005, 1e-9])  # the second misses and must widen
def test_quantiles_with_hot_value(spark, monkeypatch, slack):
    monkeypatch.setattr(quantiles, "SLACK", slack)
    if slack < 0.001:
        monkeypatch.setattr(quantiles, "SKETCH_SIZE", 8)
    rng = np.random.default_rng(1)
    a = np.where(np.arange(20000) % 3 == 0, 7.0, rng.normal(0, 100, 20000))
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": rng.exponential(5, 20000)})).withColumn("c", F.lit(3.0)).withColumn("d", F.lit(None).cast("double")).repartition(5)
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    row = quantiles.exact_quantiles(df, ["a", "b", "c", "d"], probs).first()
    pdf = df.toPandas()
    for name in ("a", "b", "c"):
        assert row[name] == pytest.approx(pdf[name].quantile(probs).tolist(), rel=1e-12)
    assert row.d == [None] * 5


def test_only_brackets_are_exchanged(spark):
    """Of a column of 200,000 values few meet in a sort, and no window runs over a target."""
    seen = []
    frame = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("a"))
    original = quantiles.with_running_totals

    def counted(df, order, sums):
        seen.append(df.count())
        return original(df, order, sums)

    quantiles.with_running_totals = counted
    try:
        row = quantiles.exact_quantiles(frame, ["a"], [0.5]).first()
    finally:
        quantiles.with_running_totals = original
    assert row.a == [pd.Series([i * 7919 % 200_003 for i in range(200_000)]).quantile(0.5)]
    assert max(seen) < 4_000


def test_caps_keep_null(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,)], "avg_amount_paid double")
    rows = [r.avg_amount_paid_capped for r in quantiles.add_capped_columns(df).orderBy("avg_amount_paid").collect()]
    assert rows[0] is None and rows[1] == 1.0 and rows[-1] == 99.0 and rows[50] == 49.0
