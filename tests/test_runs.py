import pytest

from tidemark.catalog import learning
from tidemark.operators import models as m
from tidemark.plans import runs
from tidemark.plans import train as tr

SF = "/root/testdata/sf0.001"
CONFIG = {**learning.CONFIG, "models": {"logistic_regression": {"max_iter": 10}, "boosted_shallow": {"n_estimators": 2, "max_depth": 2}, "boosted_leafy": {"n_estimators": 2, "num_leaves": 4}}}


def test_one_run_of_three_candidates_is_trained_once(spark, tmp_path, monkeypatch):
    loads, fits = [], []
    measure = m.dev_metrics
    monkeypatch.setattr(m, "dev_metrics", lambda model, dev, name: fits.append(name) or measure(model, dev, name))

    def load():
        loads.append(1)
        return learning.dataset(spark, SF)

    asked = lambda cfg: runs.stored_run(spark, [f"{SF}/customer.parquet"], load, cfg, str(tmp_path))
    first = asked(CONFIG)
    again = asked(dict(reversed(CONFIG.items())))
    assert first == again and len(loads) == 1 and sorted(fits) == ["boosted_leafy", "boosted_shallow", "logistic_regression"]
    rows = first.candidates(spark).collect()
    model, metadata = first.load(spark)
    assert len(rows) == 3 and metadata["champion_model"] == rows[0].model_name == first.test_metrics(spark).first().champion
    assert len(first.candidate("boosted_shallow").stages[-1].trees) == 2
    other = asked({**CONFIG, "split": {**CONFIG["split"], "random_state": 43}})
    assert other != first and len(loads) == 2


def test_an_interrupted_run_keeps_its_candidates(spark, tmp_path, monkeypatch):
    fits, measure = [], m.dev_metrics

    def failing(model, dev, name):
        if name == "boosted_leafy" and len(fits) < 3:
            fits.append("lost")
            raise RuntimeError("executor lost")
        fits.append(name)
        return measure(model, dev, name)

    monkeypatch.setattr(m, "dev_metrics", failing)
    asked = lambda: runs.stored_run(spark, [f"{SF}/customer.parquet"], lambda: learning.dataset(spark, SF), CONFIG, str(tmp_path))
    with pytest.raises(RuntimeError):
        asked()
    assert len(asked().candidates(spark).collect()) == 3
    assert fits == ["logistic_regression", "boosted_shallow", "lost", "boosted_leafy"]


def test_keys_follow_files_and_settings(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a")
    one = runs.run_key(spark, [f"{tmp_path}/a"], {"x": 1, "y": 2})
    assert one == runs.run_key(spark, [f"{tmp_path}/a"], {"y": 2, "x": 1}) != runs.run_key(spark, [f"{tmp_path}/a"], {"x": 1, "y": 3})
    spark.range(4).write.mode("append").parquet(f"{tmp_path}/a")
    assert one != runs.run_key(spark, [f"{tmp_path}/a"], {"x": 1, "y": 2})


def test_a_stopped_search_goes_on(spark, tmp_path, monkeypatch):
    """The declared 30 trials, stopped in the ninth and begun again: only the missing ones are fitted, and the table is that of an undisturbed search."""
    data = learning.dataset(spark, SF)
    cfg = {**CONFIG, "tuning": {"algorithm": "boosted_shallow", "n_trials": 30, "parallel": 3}}
    asked, draw = [], m.boosted_trees
    tiny = {"n_estimators": 1, "max_depth": 1}  # what is searched is the declared space; what is fitted stays small

    def trees(params, seed):
        if len(asked) == 9:
            asked.append("lost")
            raise RuntimeError("driver lost")
        asked.append(round(params["learning_rate"], 12))
        return draw({**params, **tiny}, seed)

    monkeypatch.setattr(m, "boosted_trees", trees)
    with pytest.raises(RuntimeError):
        tr.tune(spark, data, cfg, str(tmp_path))
    stopped = [x for x in asked if x != "lost"]
    best = tr.tune(spark, data, cfg, str(tmp_path))
    fitted = [x for x in asked if x != "lost"]
    assert 1 <= len(stopped) and len(set(fitted)) == 30
    asked_before = len(asked)
    assert tr.tune(spark, data, cfg, str(tmp_path)) == best and len(asked) == asked_before
    trials = spark.read.option("header", True).csv(f"{tmp_path}/tuning/trials.csv")
    assert sorted(int(r.number) for r in trials.collect()) == list(range(30))


def test_search_queries_search_the_declared_space(spark, monkeypatch):
    """m8 makes 30 trials in the declared ranges; m9 tunes by as many and trains three candidates, the tuned one with the best parameters found."""
    asked, draw = [], m.boosted_trees

    def trees(params, seed):
        asked.append(params)
        return draw({**params, "n_estimators": 1, "max_depth": 1}, seed)  # what is searched is the declared space; what is fitted stays small

    def measured(model, dev, name):
        return {"roc_auc": model.treeWeights[-1] / 2 if hasattr(model, "trees") else 0.0, "model_name": name, "dev_best_f1_scan": 0.5,
                **dict.fromkeys(("pr_auc", "f1", "precision", "recall", "threshold", "positive_rate"), 0.5)}

    monkeypatch.setattr(m, "boosted_trees", trees)
    monkeypatch.setattr(m, "dev_metrics", measured)
    space = m.SEARCH_SPACE["boosted_shallow"]
    within = lambda p: all(low <= p[k] <= high for k, (_, low, high) in space.items())
    assert learning.m8_random_search(spark, SF).count() == 30 == len(asked) and all(map(within, asked))
    assert {k for k in space if len({p[k] for p in asked}) > 3} == set(space)
    searched = {tuple(p[k] for k in space) for p in asked}
    asked.clear()
    rows = learning.m9_tuned_champion(spark, SF).collect()
    assert {r.model_name for r in rows} == {"logistic_regression", "boosted_shallow", "boosted_leafy"}
    assert {tuple(p[k] for k in space) for p in asked[:30]} == searched
    assert tuple(asked[30][k] for k in space) in searched
