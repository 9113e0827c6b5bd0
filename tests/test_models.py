"""Own forms against the library ones, and invariants of what has no SQL form."""

from __future__ import annotations

import datetime
import json
import warnings

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lumenframe.operators import linear as L
from lumenframe.operators import metrics as M
from lumenframe.operators import models as Mo
from lumenframe.operators import selection as Sel
from lumenframe.operators import series as Se
from lumenframe.operators import series_fit as SF
from lumenframe.operators import trees, tuning
from lumenframe.operators import wrappers as W
from lumenframe.plans import all_queries


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - 0.5 * x[:, 1] + 0.3 * rng.normal(size=400) > 0).astype(int)
    rows = [(i, *map(float, v), int(c), float(2 * v[0] - v[2] + 1)) for i, (v, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y int, z double").persist()


def test_least_squares_matches_library(points):
    noisy = points.withColumn("z", F.col("z") + F.sin(F.col("id").cast("double")))
    ours = {r["term"]: r for r in L.least_squares(noisy, ["a", "b", "c"], "z").collect()}
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(noisy)
    fit = LinearRegression(labelCol="z", solver="normal").fit(rows)
    assert [ours[t]["coef"] for t in "abc"] == pytest.approx(list(fit.coefficients))
    assert ours["intercept"]["coef"] == pytest.approx(fit.intercept)
    assert [ours[t]["se"] for t in ("a", "b", "c", "intercept")] == pytest.approx(fit.summary.coefficientStandardErrors)
    assert ours["a"]["r2"] == pytest.approx(fit.summary.r2)


def test_least_squares_drops_nulls(points, spark):
    holes = points.unionByName(points.limit(1).withColumn("a", F.lit(None).cast("double")))
    a = [r["coef"] for r in L.least_squares(points, ["a"], "z").collect()]
    assert [r["coef"] for r in L.least_squares(holes, ["a"], "z").collect()] == pytest.approx(a)


def test_auc_matches_library(points):
    ours = M.roc_auc(points, "y", "a").first()["auc"]
    scored = points.select(F.col("y").cast("double").alias("label"), F.col("a").alias("rawPrediction"))
    assert ours == pytest.approx(BinaryClassificationEvaluator().evaluate(scored), abs=1e-9)


@pytest.mark.parametrize("loss", ["squared", "cross_entropy", "hinge"])
def test_gradient_descent_learns(points, loss):
    target = "y" if loss == "cross_entropy" else "s"
    rows = points.withColumn("s", F.col("y") * 2 - 1)
    weights, curve = L.gradient_descent(rows, ["a", "b", "c"], target, loss, 0.3, 15, l2=0.001)
    assert len(curve) == 15 and curve[-1] < curve[0] and weights["a"] > 0 > weights["b"]


def test_hinge_of_mean_stops(points):
    rows = points.withColumn("s", F.col("y") * 2 - 1)
    _, curve = L.gradient_descent(rows, ["a"], "s", "hinge_of_mean", 0.01, 5)
    assert curve[0] == 1 and curve[-1] == 0


def test_tree_root_matches_library(points):
    ours = trees.grow_tree(points, ["a", "b", "c"], "y", depth=1).filter("node = 1").first()
    model = Mo.tree(1).setMaxBins(512).fit(Mo.assemble(points, ["a", "b", "c"], "y"))
    root = model._call_java("rootNode").split()
    assert ["a", "b", "c"].index(ours["feature"]) == root.featureIndex()
    assert ours["thr"] == pytest.approx(root.threshold())


def test_tree_fits_signal(points):
    tree = trees.grow_tree(points, ["a", "b", "c"], "y", depth=3, criterion="entropy", min_leaf=5)
    scored = trees.tree_predict(points, tree, 3)
    assert scored.filter("pred IS NULL").count() == 0
    assert M.accuracy(scored, "y", "pred").first()["accuracy"] > 85
    leaves = tree.filter("feature IS NULL")
    assert leaves.agg(F.sum("n"), F.min("n")).first()[0] == 400


def test_boosting(points):
    rows = Mo.assemble(points, ["a", "b", "c"], "y", ["id"])
    models, alphas, classes = Mo.samme_fit(rows, 6)
    assert len(models) == len(alphas) and all(a > 0 for a in alphas) and classes == [0.0, 1.0]
    scored = Mo.samme_predict(rows, models, alphas, classes)
    stump = models[0].transform(rows)
    scores = {r["model"]: r["accuracy"] for r in Mo.score_models({"boost": scored, "stump": stump}).collect()}
    assert scores["boost"] >= scores["stump"] and scored.count() == 400


def test_naive_bayes_matches_library(spark):
    rng = np.random.default_rng(2)
    x = rng.poisson([[2, 1, 0.5, 1]], size=(120, 4)) + (rng.integers(0, 2, (120, 1)) * [[2, 0, 0, 1]])
    y = (x[:, 0] + rng.integers(0, 3, 120) > 4).astype(int)
    counts = spark.createDataFrame([(i, f"t{j}", int(x[i, j])) for i in range(120) for j in range(4) if x[i, j]], "id int, term string, cnt long")
    labels = spark.createDataFrame([(i, int(c)) for i, c in enumerate(y)], "id int, y int")
    model, priors = Sel.naive_bayes_fit(counts, labels, "id", "y")
    ours = {r["id"]: r["pred"] for r in Sel.naive_bayes_predict(counts, labels, "id", model, priors).collect()}
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(i, float(y[i]), Vectors.dense(x[i].astype(float))) for i in range(120)], ["id", "label", "features"])
    fit = Mo.naive_bayes().fit(rows)
    theirs = {r["id"]: int(r["prediction"]) for r in fit.transform(rows).collect()}
    # the library smooths the class shares as well, which moves a row on the border at most
    assert sum(ours[i] != theirs[i] for i in ours) <= 2


def test_selection_wrappers(points):
    rows = Mo.assemble(points, ["a", "b", "c"], "y", ["id"])
    assert W.rfe_select(rows, 3, 2) == [0, 1]
    chosen = W.forward_select(rows, "id", range(3), 2)
    assert chosen[0][0] == 0 and len({f for f, _ in chosen}) == 2
    weight = W.importances(rows, 10)
    assert weight.argmax() == 0 and weight.sum() == pytest.approx(1)


def test_draws_are_seeded():
    space = {"d": tuning.IntRange(1, 8), "c": tuning.FloatRange(0.1, 2.0), "k": tuning.Choice(("a", "b"))}
    first, second = tuning.draws(space, 20, 1), tuning.draws(space, 20, 1)
    assert first == second and tuning.draws(space, 20, 2) != first
    assert all(1 <= p["d"] <= 8 and 0.1 <= p["c"] <= 2 and p["k"] in "ab" for p in first)
    assert tuning.best_trial([({}, 0, 0.5), ({}, 0, 0.7), ({}, 0, 0.7)]) == 1


def frame(spark, ys, key="a"):
    rows = [(key, datetime.date(2020, 1, 6) + datetime.timedelta(days=7 * i), float(y)) for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "k string, d date, y double")


def test_unit_root():
    rng = np.random.default_rng(0)
    noise = rng.normal(size=400)
    assert SF.unit_root_test(noise)[1] < 0.01
    assert SF.unit_root_test(np.cumsum(noise))[1] > 0.05
    assert SF.unit_root_p(-2.86) == pytest.approx(0.05, abs=0.002)
    assert SF.unit_root_p(-3.43) == pytest.approx(0.01, abs=0.001)
    assert SF.unit_root_p(5) == 1 and SF.unit_root_p(-30) == 0
    assert np.isnan(SF.unit_root_test(np.ones(50))[0]) and np.isnan(SF.unit_root_test(np.ones(1))[0])


def test_stationarity(spark):
    walk = 50 + np.cumsum(np.random.default_rng(1).normal(size=200))
    rows = SF.stationarity(frame(spark, walk), ["k"], "d", "y", 13).collect()
    assert len(rows) == 6 and sum(r["best"] for r in rows) == 1
    best = next(r for r in rows if r["best"])
    assert best["p_value"] == min(r["p_value"] for r in rows) and best["transform"] not in ("level", "log")


def test_arma_recovers_coefficients(spark):
    rng = np.random.default_rng(4)
    e, y = rng.normal(size=3000), np.zeros(3000)
    for t in range(1, 3000):
        y[t] = 0.6 * y[t - 1] + e[t] + 0.4 * e[t - 1]
    fit = {r["term"]: r["coef"] for r in SF.hannan_rissanen(frame(spark, y), ["k"], "d", "y", 1, 1).collect()}
    assert fit["ar1"] == pytest.approx(0.6, abs=0.08) and fit["ma1"] == pytest.approx(0.4, abs=0.08)


def test_lag_ridge_matches_numpy(spark):
    y = np.sin(np.arange(120) / 3) + np.random.default_rng(6).normal(size=120) * 0.1
    lags = Se.lag_columns(2, 1, 7)
    assert lags == {"l1": 1, "l2": 2, "s7": 7, "m7_1": 8, "m7_2": 9}
    row = SF.lag_ridge(frame(spark, y), ["k"], "d", "y", lags, 0.1).first()
    x = np.column_stack([np.r_[np.zeros(n), y[:-n]] for n in lags.values()])
    want = np.linalg.solve(x.T @ x + 0.1 * np.eye(5), x.T @ y)
    assert [row[t] for t in lags] == pytest.approx(want)


def test_forecast_integrates():
    trend = 3.0 * np.arange(60) + 5
    assert SF.forecast_values(trend, (0, 1, 0), (0, 0, 0, 1), 4) == pytest.approx([185, 188, 191, 194])
    season = np.tile([1.0, 5.0, 9.0], 20)
    assert SF.forecast_values(season, (0, 0, 0), (0, 1, 0, 3), 4) == pytest.approx([1, 5, 9, 1])
    both = season + trend
    assert SF.forecast_values(both, (0, 1, 0), (0, 1, 0, 3), 3) == pytest.approx(np.array([185, 188, 191]) + [1, 5, 9])


def test_order_search_survives_bad_orders(spark):
    rows = SF.order_search(frame(spark, [1, 2, 1]), ["k"], "d", "y", [(1, 0, 0, 0), (0, 0, 2, 2)], 1, 1, 13).collect()
    assert len(rows) == 2 and all(r["aic"] is None for r in rows)


def test_integrate_predictions_inverts(spark):
    y = np.random.default_rng(8).normal(size=40).cumsum()
    df = frame(spark, y)
    rows = Se.difference_levels(df, ["k"], "d", "y", 2, 1, 4)
    exact = rows.select("k", "d", "y", F.col("_s1").alias("p"))
    out = Se.integrate_predictions(exact, ["k"], "d", "y", "p", "lv", 2, 1, 4).filter("lv IS NOT NULL")
    assert out.count() == 40 - 6 and out.agg(F.max(F.abs(F.col("lv") - F.col("y")))).first()[0] < 1e-9


def scores(spark, folder, name):
    return all_queries()[name](spark, folder).collect()


def test_search_results(spark, folder):
    rows = scores(spark, folder, "holdout_search")
    assert sum(r["best"] for r in rows) == 1
    assert next(r for r in rows if r["best"])["f1"] == max(r["f1"] for r in rows)
    names = {"model", "depth", "trees", "min_leaf", "criterion", "penalty"}
    assert len(rows) == 100 and all(set(json.loads(r["params"])) == names for r in rows)
    assert {json.loads(r["params"])["model"] for r in rows} == {"tree", "forest", "logistic", "linear_svm"}


def test_selected_terms(spark, folder):
    rows = scores(spark, folder, "importance_select")
    assert [r["rank"] for r in rows] == sorted(r["rank"] for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows) and len({r["term"] for r in rows}) == len(rows)


def test_effect_table(spark, folder):
    rows = scores(spark, folder, "select_then_score")
    selectors = ("none", "chi2", "mutual_info", "variance", "rfe", "forward", "importance")
    classifiers = ("naive_bayes", "logistic", "tree", "linear_svm")
    assert sorted((r["selector"], r["model"]) for r in rows) == sorted((s, c) for s in selectors for c in classifiers)
    assert all(0 <= r["accuracy"] <= 100 and 0 <= r["f1"] <= 1 for r in rows)


def test_caller_functions(points):
    """The caller's own learning curve, prediction transform and search metric."""
    hits = lambda y, z: F.avg(F.when((z > 0) == (y > 0), 1.0).otherwise(0.0))
    weights, curve = L.gradient_descent(points, ["a", "b"], "y", "cross_entropy", 0.5, 4, curve_of=hits)
    assert 0.4 < curve[0] < 0.6 and curve[-1] > 0.8
    pred = L.linear_score(weights, lambda z: F.when(z > 0, 1).otherwise(0))
    assert M.accuracy(points.withColumn("p", pred), "y", "p").first()["accuracy"] > 80
    rows = Mo.assemble(points, ["a", "b", "c"], "y", ["id"])
    found = tuning.run_trials(rows, rows, lambda p: Mo.tree(p["d"]), [{"d": 1}, {"d": 3}], metric=M.binary_f1)
    assert found[1][2] > found[0][2] > 0.5 and found[1][1] > found[0][1]


def test_elimination_fits_end_by_tolerance(points, spark, folder, monkeypatch):
    """The registered query leaves the iterations to the operator, which warns of fits that the cap ends."""
    from lumenframe.plans import models as plans

    seen = []
    monkeypatch.setattr(plans, "term_parts", lambda *_: (["a", "b", "c"], Mo.assemble(points, ["a", "b", "c"], "y", ["id"])))
    monkeypatch.setattr(plans, "TOP", 2)
    monkeypatch.setattr(Mo, "linear_svm", lambda n, c, i, real=Mo.linear_svm: seen.append(i) or real(n, c, i))
    assert [r["term"] for r in scores(spark, folder, "rfe_select")] == ["a", "b"] and seen == [100]
    rows = Mo.assemble(points, ["a", "b", "c"], "y", ["id"])
    with pytest.warns(RuntimeWarning, match="stopped after 1 iterations"):
        W.rfe_select(rows, 3, 2, iterations=1)
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)
        assert W.rfe_select(rows, 3, 2) == [0, 1]


def test_trials_scan_their_rows_once(points):
    """Both parts are kept while the trials last and let go after them; what the caller keeps stays."""
    rows = Mo.assemble(points, ["a", "b"], "y", ["id"])
    train, test = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0").persist()
    kept, want = [], [Mo.tree(d).fit(train).transform(test).filter("label = prediction").count() for d in (1, 2)]

    class Probe:
        def __init__(self, depth):
            self.depth = depth

        def fit(self, df):
            kept.append(df.storageLevel.useMemory and test.storageLevel.useMemory)
            return Mo.tree(self.depth).fit(df)

    found = tuning.run_trials(train, test, Probe, [1, 2])
    assert kept == [True, True] and [round(a * test.count() / 100) for _, a, _ in found] == want
    assert not train.storageLevel.useMemory and test.storageLevel.useMemory
    test.unpersist()


def test_registered_searches_are_whole(points, spark, folder, monkeypatch):
    """100 trials, every depth that the estimators take and all forest sizes."""
    from lumenframe.plans import models as plans

    rows = Mo.assemble(points, ["a", "b", "c"], "y", ["id"]).withColumnRenamed("id", "doc_id")
    monkeypatch.setattr(plans, "shape_parts", lambda *_: (rows.withColumn("part", F.lit("train")), rows))
    monkeypatch.setattr(tuning, "run_trials", lambda train, test, build, trials: [(p, 1.0, 1.0) for p in trials if build(p)])
    assert len(scores(spark, folder, "holdout_search")) == 100
    swept = [(r["model"], r["value"]) for r in scores(spark, folder, "depth_sweep")]
    assert sorted(v for m, v in swept if m == "tree") == list(range(1, 31))
    assert sorted(v for m, v in swept if m == "forest") == [1, 2, 5, 10, 20, 50, 100]


def test_forward_terms_of_the_effect_table_are_whole(spark, folder, monkeypatch):
    """As many terms of the forward selection as of every other selector, each the best of its step by brute force."""
    from lumenframe.plans import models as plans

    rng = np.random.default_rng(8)
    x, y = rng.poisson(0.7, size=(90, 40)), rng.integers(0, 2, 90)
    terms = [f"t{j:02d}" for j in range(40)]
    counts = spark.createDataFrame([(i, terms[j], int(x[i, j])) for i in range(90) for j in range(40) if x[i, j]], "doc_id int, term string, cnt int")
    labels = spark.createDataFrame([(i, int(c)) for i, c in enumerate(y)], "doc_id int, quality int")
    rows = labels.select("doc_id", F.col("quality").cast("double").alias("label"))
    monkeypatch.setattr(plans, "term_parts", lambda *_: (terms, rows, rows, counts, labels))
    monkeypatch.setattr(W, "importances", lambda *_: [0.0] * 40)
    monkeypatch.setattr(W, "rfe_select", lambda *_, **__: [])
    kept = {}
    monkeypatch.setattr(W, "effect_of_selection", lambda a, b, selections, c: kept.update(selections) or [("s", "m", 0.0, 0.0, 0.0)])
    scores(spark, folder, "select_then_score")
    chosen, t = [], y * 2.0 - 1
    for _ in range(30):
        def r2(cols):
            a = np.column_stack([np.ones(90), *[x[:, c] for c in cols]])
            e = t - a @ np.linalg.lstsq(a, t, rcond=None)[0]
            return 1 - e @ e / ((t - t.mean()) @ (t - t.mean()))

        chosen.append(max((c for c in range(40) if c not in chosen), key=lambda c: round(r2([*chosen, c]), 9)))
    assert kept["forward"] == chosen and len(kept["chi2"]) == 30


def test_classifiers_keep_their_size(points, spark, folder, monkeypatch):
    """Every train term of the text classifier has a weight of its own, and forest and boosting have the reference's sizes."""
    from lumenframe.plans import models as plans

    spoken = [(i, " ".join(f"w{(i * 7 + j) % 200}x{i}" for j in range(500)) + f" a {'good' if i % 2 else 'bad'}") for i in range(50)]
    docs = spark.createDataFrame(spoken, "doc_id int, text string")
    monkeypatch.setattr(plans, "texts", lambda *_: docs)
    monkeypatch.setattr(plans, "compounds", lambda *_: docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, -0.9).otherwise(0.9).alias("compound")))
    fitted, made, real = [], [], plans.softmax_fit

    def fit(values, labels, *args, **kwargs):
        fitted.append((labels.count(), real(values, labels, *args, **kwargs)))
        return fitted[-1][1]

    monkeypatch.setattr(plans, "softmax_fit", fit)
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)
        assert scores(spark, folder, "text_classifier")
    n, model = fitted[0]
    # "a" is in every text, so that its idf is 0
    assert {"good", "bad"} <= (terms := {r["term"] for r in model.weights.collect()}) and "a" not in terms and len(terms) == n * 200 + 2
    rows = Mo.assemble(points, ["a", "b", "c"], "y", ["id"])
    monkeypatch.setattr(plans, "shape_parts", lambda *_: (rows, rows))
    monkeypatch.setattr(Mo, "forest", lambda trees, *a, real=Mo.forest: made.append(trees) or real(2, *a))
    monkeypatch.setattr(Mo, "samme_fit", lambda train, rounds, real=Mo.samme_fit: made.append(rounds) or real(train, 2))
    assert len(scores(spark, folder, "forest_fit")) == 3 and len(scores(spark, folder, "samme_fit")) == 1
    assert made == [100, 100, 100, 50]
