"""One test per fault mended: null keys, large means, zero vectors, odd classes, long word lists, shipping."""

from __future__ import annotations

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.functions.scalars import progress
from lumenframe.operators import linear, models, neighbors, profile, selection, series, series_fit, splits, text, trees
from lumenframe.operators.position import exact_quantiles, order_statistics, running_sums, with_position

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def keyed(spark):
    rows = [("a", i, float(i)) for i in range(4)] + [(None, i, 10.0 + i * i) for i in range(5)] + [("b", 1, None)]
    return spark.createDataFrame(rows, "k string, t int, v double")


def test_null_is_a_key(keyed):
    assert profile.zscore(keyed, ["k"], "v").count() == 10
    assert {r.k: r.q2 for r in exact_quantiles(keyed, ["k"], "v", {"q2": 0.5}).collect()} == {"a": 1.5, None: 14.0}
    assert {r.k: (r.lo, r.hi) for r in profile.box_summary(keyed, ["k"], "v").collect()} == {"a": (0.0, 3.0), None: (10.0, 26.0)}
    placed = {(r.k, r.t): r.pos for r in with_position(keyed, ["k"], ["t"]).collect()}
    assert len(placed) == 10 and placed[(None, 4)] == 5 and placed[("b", 1)] == 1
    assert running_sums(keyed, ["k"], ["t"], ["v"]).count() == 10
    parts = {(r.k, r.t): r.part for r in splits.holdout_chrono(keyed, ["k"], "t", "v", 0.6).collect()}
    assert len(parts) == 10 and parts[(None, 2)] == "train" and parts[(None, 3)] == "test"


def test_series_without_times_are_kept(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", 1, 1)], "k string, t int, id int")
    got = sorted((r.k, r.id, r.part) for r in splits.holdout_chrono(rows, ["k"], "t", "id", 0.5).collect())
    assert got == [("a", 1, "test"), ("a", 2, "test"), ("b", 1, "train")]


def test_no_window_over_all_slots(spark):
    rows = spark.range(300_000).withColumn("v", F.xxhash64("id"))
    stats = order_statistics(rows, [], "v", {"m": (0.5, lambda n: n / 2)})
    want = rows.orderBy("v").limit(150_001).agg(F.max("v")).first()[0]
    assert stats.first()["lo"] == want
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "_top" not in "".join(line for line in plan.splitlines() if "SinglePartition" in line)


def test_profile_keeps_large_whole_numbers(spark):
    df = spark.createDataFrame([(2**60,), (2**60 + 3,)], "n long")
    assert profile.column_profile(df, ["n"]).first()["rng"] == 3.0


def test_least_squares_far_from_zero(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=400) + 1e8
    rows = [(float(a), float(2 * (a - 1e8) + 5 + e)) for a, e in zip(x, rng.normal(scale=0.1, size=400))]
    got = {r.term: r for r in linear.least_squares(spark.createDataFrame(rows, "x double, y double"), ["x"], "y").collect()}
    assert got["x"].coef == pytest.approx(2.0, abs=0.02) and 0.99 < got["x"].r2 < 1 and 0 < got["x"].se < 0.02


def test_votes_without_weight_and_text_classes(spark):
    near = spark.createDataFrame([(1, 1, 1.0, 6), (1, 2, 1.0, 5), (1, 3, 1.0, 6)], "probe int, rank int, dist double, label int")
    assert neighbors.vote(near, label="label", kernel="uniform", bandwidth=0.5).first()["pred"] == 5
    assert neighbors.vote(near, label="label", kernel="uniform", bandwidth=0.5, lowest=F.lit(4)).first()["pred"] == 4
    named = near.withColumn("label", F.when(F.col("label") == 6, "x").otherwise("w"))
    assert neighbors.distance_vote(named, label="label", k=3).first()["pred"] == "x"


def test_zero_vectors_have_cosine_distance_one(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 2.0])], "id int, v array<double>")
    near = neighbors.nearest(rows, rows, 3, id_col="id", vec_col="v", metric="cosine").collect()
    dist = {(r.probe, r.nb): round(r.dist, 9) for r in near}
    assert dist[(2, 1)] == dist[(2, 2)] == dist[(1, 2)] == 1.0 and dist[(1, 1)] == 0.0 and dist[(1, 3)] == 1.0


def test_moments_equal_blocks(spark):
    rng = np.random.default_rng(2)
    rows = spark.createDataFrame([(i, rng.normal(size=5).tolist(), float(i % 3)) for i in range(60)], "id int, v array<double>, w double")
    named = {"poly": ("poly", 2.0), "lin": ("linear", 0.0)}
    arguments = {"id_col": "id", "vec_col": "v", "weight": "w", "kernels": named}
    a = {r.id: (r.poly, r.lin) for r in neighbors.kernel_moments(rows, rows, **arguments).collect()}
    b = {r.id: (r.poly, r.lin) for r in neighbors.kernel_fold(rows, rows, **arguments).collect()}
    assert all(a[i] == pytest.approx(b[i]) for i in b) and len(a) == 60


def test_sweep_equals_single_votes(spark):
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, rng.normal(size=3).tolist(), int(rng.integers(3))) for i in range(80)], "id int, v array<double>, label int")
    near = neighbors.nearest(rows, rows, 13, id_col="id", vec_col="v", carry=["label"])
    lists = neighbors.nearest_lists(rows, rows, 13, id_col="id", vec_col="v", carry=["label"])
    for kernel in ("gaussian", "triangular", "epanechnikov", "uniform"):
        swept = neighbors.sweep_k(lists, label="label", kernel=kernel, k_max=12, lowest=F.lit(0)).collect()
        for k in (1, 4, 12):
            one = {r.probe: r.pred for r in neighbors.vote(near, label="label", kernel=kernel, k=k, lowest=F.lit(0)).collect()}
            assert {r.probe: r.pred for r in swept if r.k == k} == one


def test_sweep_counts_equal_its_votes_and_leave_no_row_per_vote(spark):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=3).tolist(), int(rng.integers(3)), "ab"[i % 2] if i % 7 else None) for i in range(90)]
    rows = spark.createDataFrame(rows + [(i, rows[5][1], 2, "a") for i in range(90, 110)], "id int, v array<double>, label int, part string")
    train = rows.filter("id % 4 > 0")
    for kernel in ("gaussian", "epanechnikov"):
        lists = neighbors.nearest_lists(train, rows, 100, id_col="id", vec_col="v", carry=["label"])
        swept = neighbors.sweep_k(lists, label="label", kernel=kernel, k_max=99, lowest=F.lit(1))
        held = swept.join(rows.selectExpr("id AS probe", "label", "part"), "probe").groupBy("part", "k")
        want = {(r.part, r.k): (r.hits, r.n) for r in held.agg(F.sum((F.col("pred") == F.col("label")).cast("int")).alias("hits"), F.count("k").alias("n")).collect()}
        made = neighbors.sweep_hits(train, rows, id_col="id", vec_col="v", label="label", kernel=kernel, k_max=99, keys=["part"], lowest=1)
        assert {(r.part, r.k): (r.hits, r.probes) for r in made.collect()} == want and len(want) > 200
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("MapInArrow")[0] and "RoundRobin" not in plan


def test_blocks_return_few_more_rows_than_wanted(spark):
    """However many blocks a probe meets, the second pass returns less than 2 m rows for it."""
    rng = np.random.default_rng(9)
    v = rng.normal(size=(3000, 8))
    v[:900] = v[0] + 0.01 * rng.normal(size=(900, 8))
    train = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id int, v array<double>")
    probe = train.filter("id % 30 = 0")
    for m, block, pivots in ((40, 150, 4), (400, 400, None)):
        options = {"id_col": "id", "vec_col": "v", "rows_per_block": block, "pivots": pivots}
        lists, several = neighbors.block_lists(train, probe, m, **options)
        sent = lists.groupBy("probe").agg(F.sum(F.size("dist")).alias("n")).agg(F.max("n"), F.min("n"), F.count("n")).first()
        assert several and m <= sent[1] and sent[0] < 2 * m and sent[2] == 100
        got = neighbors.nearest(train, probe, m, **options).groupBy("probe").agg(F.sort_array(F.collect_list(F.struct("rank", "nb"))).alias("x"))
        d = np.linalg.norm(v[::30, None] - v[None], axis=2)
        want = {30 * i: np.lexsort((np.arange(3000), np.round(row, 12)))[:m].tolist() for i, row in enumerate(d)}
        assert {r.probe: [x.nb for x in r.x] for r in got.collect()} == want


def clustered(n=1200, dims=32, centers=60):
    """Vectors of small clusters of unlike sizes, some of them equal."""
    rng = np.random.default_rng(4)
    middle = rng.normal(size=(centers, dims))
    v = middle[rng.integers(centers, size=n) * rng.integers(2, size=n)] + 0.08 * rng.normal(size=(n, dims))
    v[::10] = v[5]
    return v


def test_approximate_join_recall_and_pairs_met(spark):
    v = clustered()
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(-1, None)], "id int, v array<double>")
    d = np.linalg.norm(v[:, None] - v[None], axis=2)
    radius = 0.9
    settings = {"bits": 14, "tables": 12, "probes": 16}
    got = {(r.probe, r.nb) for r in neighbors.approximate_join(rows, rows, radius, id_col="id", vec_col="v", **settings).collect()}
    want = set(zip(*(x.tolist() for x in np.nonzero(d <= radius)), strict=True))
    assert got <= set(zip(*(x.tolist() for x in np.nonzero(d <= radius + 1e-9)), strict=True))
    assert len(got & want) >= 0.95 * len(want)
    # a radius that leaves out 99 % of the pairs of two points from unlike clusters: few of them may be met
    spread = np.random.default_rng(5).normal(size=(40, 32)).repeat(25, axis=0)
    spread += 0.05 * np.random.default_rng(6).normal(size=spread.shape)
    assert (np.linalg.norm(spread[:, None] - spread[None], axis=2) <= radius).mean() < 0.03
    points = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(spread)], "_id int, _vec array<double>")
    assert neighbors.candidate_pairs(points, points, **settings).count() < 0.1 * len(spread) ** 2


def test_approximate_join_folds_copies(spark):
    rows = spark.createDataFrame([(i, [1.0, 2.0, 3.0, float(i % 2)]) for i in range(400)], "id int, v array<double>")
    assert neighbors.approximate_join(rows, rows, 0.5, id_col="id", vec_col="v").count() == 2 * 200**2
    empty = rows.limit(0)
    assert neighbors.approximate_join(empty, rows, 0.5, id_col="id", vec_col="v").count() == 0


def test_approximate_join_on_embeddings(spark, folder):
    """Recall of the registered query against all pairs."""
    from lumenframe.plans import all_queries
    from lumenframe.plans.neighbors import NEAR, split

    train, test = (np.array([(r.vec_id, *r.embedding) for r in part.collect()], "float64") for part in split(spark, folder))
    d = np.linalg.norm(test[:, None, 1:] - train[None, :, 1:], axis=2)
    want = {(int(test[i, 0]), int(train[j, 0])) for i, j in zip(*np.nonzero(d <= NEAR))}
    got = {(r.probe, r.nb) for r in all_queries()["knn_lsh"](spark, folder).collect()}
    assert len(got & want) >= 0.95 * len(want)


def test_long_word_lists_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "the cats was not good and cats"), (1, "the cats was not good and cats"), (2, None), (3, "")], "id int, text string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("was", "be")], "form string, lemma string")
    lexicon = spark.createDataFrame([("good", 1.0), ("cats", -0.5)], "word string, valence double")
    modifiers = spark.createDataFrame([("not", "negation"), ("and", "booster")], "word string, kind string")

    def run():
        a = sorted(map(tuple, text.lemmatize(docs, "id", "text", lemmas).collect()), key=str)
        return a, sorted(map(tuple, text.sentiment(docs, "id", "text", lexicon, modifiers).collect()), key=str)

    short = run()
    monkeypatch.setattr(text, "LITERAL_WORDS", 0)
    assert run() == short
    assert ("the cat be not good and cat", 3) in {r[1:] for r in short[0]}
    s = -0.5 - 0.74 - 0.5 - 0.293
    assert {round(r[1], 9) for r in short[1] if r[0] == 1} == {round(s / (s * s + 15) ** 0.5, 9)}


def test_forward_terms_equal_least_squares(spark):
    rng = np.random.default_rng(5)
    x, y = rng.poisson(0.7, size=(60, 8)), rng.integers(0, 2, 60)
    counts = spark.createDataFrame([(i, f"t{j}", int(x[i, j])) for i in range(60) for j in range(8) if x[i, j]], "id int, term string, cnt int")
    labels = spark.createDataFrame([(i, int(c)) for i, c in enumerate(y)], "id int, q int")
    got = selection.forward_terms(counts, labels, "id", F.col("q") == 1, 4).orderBy("step").collect()
    chosen, t = [], y * 2.0 - 1
    for r in got:
        def r2(cols):
            a = np.column_stack([np.ones(60), *[x[:, c] for c in cols]])
            e = t - a @ np.linalg.lstsq(a, t, rcond=None)[0]
            return 1 - e @ e / ((t - t.mean()) @ (t - t.mean()))

        best = max((c for c in range(8) if c not in chosen), key=lambda c: round(r2([*chosen, c]), 9))
        chosen.append(best)
        assert r.term == f"t{best}" and r.r2 == pytest.approx(r2(chosen))


def test_tree_does_not_replay_levels(spark):
    rows = spark.createDataFrame([(i % 7 + 0.0, (i * 13) % 11 + 0.0, int((i % 7) * 3 + (i * 13) % 11 > 15)) for i in range(200)], "a double, b double, y int")
    tree = trees.grow_tree(rows, ["a", "b"], "y", depth=4)
    assert "Join" not in tree._jdf.queryExecution().executedPlan().toString()
    hit = trees.tree_predict(rows, tree, 4).agg(F.avg((F.col("pred") == F.col("y")).cast("int"))).first()[0]
    assert hit > 0.9


def test_progress_of_odd_styles(spark):
    styles = [
        "background: linear-gradient(to right, #29b 0%, #29b 37.5%, #eee 37.5%, #eee 100%)", "background: none", None,
        "linear-gradient(to right, a 1%, b 2%, c x%)", "linear-gradient(to right, a 1%)", "linear-gradient(90deg, a 1%, b 2%, c 3%)",
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(styles)], "i int, s string")
    got = [r.p for r in df.select("i", progress(F.lit("open"), F.col("s")).alias("p")).orderBy("i").collect()]
    assert got == [0.375, 0.0, 0.0, 0.0, 0.0, 0.0]


def test_entry_runs_from_another_folder(tmp_path):
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "print('rows', e.entry(s).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 1" in done.stdout, done.stderr[-2000:]


def test_null_series_are_series_like_others(spark):
    rng = np.random.default_rng(12)
    rows = [(k, i, float(rng.normal())) for k in ("a", None) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, t int, y double")
    lags = {"l1": 1, "l2": 2}
    fit = series_fit.lag_ridge(df, ["k"], "t", "y", lags, 0.1)
    assert series_fit.in_sample(df, ["k"], "t", "y", lags, fit).filter("k IS NULL").count() == 60
    tested = series_fit.stationarity(df, ["k"], "t", "y", 12).collect()
    assert {r.k for r in tested} == {"a", None} and sum(r.best for r in tested) == 2
    orders = series_fit.order_search(df, ["k"], "t", "y", [(1, 0, 0, 0), (2, 0, 0, 0)], 0, 0, 12).collect()
    assert len(orders) == 4 and sum(bool(r.best) for r in orders) == 2


def test_null_keys_in_resampled_and_combined_series(spark):
    days = spark.createDataFrame([(k, f"2024-01-0{d}", d) for k in ("a", None) for d in (1, 2, 5)], "k string, d string, y int")
    days = days.withColumn("d", F.to_date("d"))
    got = series.resample_first(days, ["k"], "d", "y", "y", 2).filter("k IS NULL").orderBy("bin_start").collect()
    assert [r["first"] for r in got] == [1, None, 5]
    a = spark.createDataFrame([(None, 1, 1.0), (None, 2, None), ("x", 1, None)], "k string, t int, y double")
    b = spark.createDataFrame([(None, 1, 9.0), (None, 2, 8.0), ("x", 1, None), ("x", 2, 7.0)], "k string, t int, y double")
    got = series.combine_first(a, b, ["k", "t"], "y").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 1, 1.0), (None, 2, 8.0), ("x", 1, None), ("x", 2, 7.0)], key=str)


def test_words_listed_twice_have_their_least_value(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "cats was good")], "id int, text string")
    lemmas = spark.createDataFrame([("cats", "kitten"), ("cats", "cat"), ("was", "be"), (None, "x")], "form string, lemma string")
    for limit in (2000, 0):
        monkeypatch.setattr(text, "LITERAL_WORDS", limit)
        assert [r.lemmas for r in text.lemmatize(docs, "id", "text", lemmas).collect()] == ["cat be good"]


def test_prefixes_of_a_forest(spark):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(200, 3))
    rows = [(i, *map(float, v), float(v[0] + v[1] > 0)) for i, v in enumerate(x)]
    df = models.assemble(spark.createDataFrame(rows, "id int, a double, b double, c double, y double"), ["a", "b", "c"], "y", ["id"])
    model = models.forest(6, 3).fit(df)
    got = models.forest_prefixes(model, df, "id").collect()
    assert len(got) == 200 * 6
    whole = {r.id: r.prediction for r in model.transform(df).collect()}
    first = {r.id: r.prediction for r in model.trees[0].transform(df).collect()}
    last = {r.id: r.prediction for r in got if r["size"] == 6}
    assert np.mean([last[i] == whole[i] for i in whole]) > 0.99
    assert {r.id: r.prediction for r in got if r["size"] == 1} == first
