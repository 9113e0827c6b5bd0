"""Distributed forms against the plain ones: hot keys, ties, copies, any number of partitions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lumenframe.operators import neighbors as N
from lumenframe.operators import position as P
from lumenframe.operators import splits, trees
from lumenframe.operators.prep import label_codes


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """50,000 rows; one key holds two thirds of them, one value a third."""
    rng = np.random.default_rng(7)
    n = 50_000
    key = np.where(rng.random(n) < 0.67, 0, rng.integers(1, 20, n))
    value = np.where(rng.random(n) < 0.33, 5.0, np.round(rng.exponential(10, n), 3))
    import pandas as pd

    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "v": value})
    return pdf, spark.createDataFrame(pdf).repartition(8).persist()


def test_quantiles_match_numpy(skewed):
    pdf, df = skewed
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}
    got = {r["k"]: [r[n] for n in probs] for r in P.exact_quantiles(df, ["k"], "v", probs).collect()}
    for k, part in pdf.groupby("k"):
        assert got[k] == pytest.approx(np.quantile(part["v"], list(probs.values())))
    whole = P.exact_quantiles(df, [], "v", probs).first()
    assert list(whole) == pytest.approx(np.quantile(pdf["v"], list(probs.values())))


def test_quantiles_edges(spark):
    empty = spark.createDataFrame([], "k int, v double")
    assert P.exact_quantiles(empty, ["k"], "v", {"m": 0.5}).count() == 0
    one = spark.createDataFrame([(1, 3.0), (1, None), (2, None)], "k int, v double")
    assert rows_of(P.exact_quantiles(one, ["k"], "v", {"m": 0.5})) == [(1, 3.0)]


def test_position_matches_window(skewed, partitions):
    _, df = skewed
    naive = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")).cast("long"))
    want = rows_of(naive.select("id", "pos"))
    for got in partitions(lambda: rows_of(P.with_position(df, ["k"], ["v", "id"]).select("id", "pos"))):
        assert got == want


@pytest.mark.parametrize("ranges", [None, 1, 13])
def test_running_sums(skewed, ranges):
    pdf, df = skewed
    folded = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    got = P.running_sums(folded, ["k"], ["v"], ["n"], following="v", totals=True, partitions=ranges).toPandas().sort_values(["k", "v"])
    base = pdf.groupby(["k", "v"]).size().rename("n").reset_index()
    assert (got["cum_n"].to_numpy() == base.groupby("k")["n"].cumsum().to_numpy()).all()
    assert (got["tot_n"].to_numpy() == base.groupby("k")["n"].transform("sum").to_numpy()).all()
    nxt = base.groupby("k")["v"].shift(-1)
    assert np.array_equal(got["next_v"].to_numpy(), nxt.to_numpy(), equal_nan=True)


def test_splits_cover(skewed, partitions):
    pdf, df = skewed
    for name, fn in {
        "ordered": lambda: splits.holdout_ordered(df, "id", 0.2),
        "hashed": lambda: splits.holdout_hashed(df, "id", 75),
        "chrono": lambda: splits.holdout_chrono(df, ["k"], "v", "id"),
    }.items():
        runs = partitions(lambda fn=fn: rows_of(fn().select("id", "part")), (1, 50))
        assert runs[0] == runs[1], name
        assert [r[0] for r in runs[0]] == sorted(pdf["id"])
    part = dict(rows_of(splits.holdout_ordered(df, "id", 0.2).select("id", "part")))
    assert all((part[i] == "train") == (i < 40_000) for i in part)


def test_chrono_matches_sort(skewed):
    pdf, df = skewed
    for rounding, size in (("ceil", np.ceil), ("floor", np.floor)):
        got = {r["id"] for r in splits.holdout_chrono(df, ["k"], "v", "id", 0.8, rounding).filter("part = 'train'").collect()}
        want = set()
        for _, g in pdf.sort_values(["v", "id"]).groupby("k"):
            want |= set(g["id"].iloc[: int(size(len(g) * 0.8))])
        assert got == want


def test_chrono_single_row(spark):
    df = spark.createDataFrame([(1, 1, 1)], "k int, t int, id int")
    assert splits.holdout_chrono(df, ["k"], "t", "id").first()["part"] == "train"
    assert splits.holdout_chrono(df, ["k"], "t", "id", 0.8, "floor").first()["part"] == "test"


def test_label_codes_any_size(spark):
    df = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("v"))
    codes = {r["v"]: r["code"] for r in label_codes(df, "v").collect()}
    assert codes == {v: i for i, v in enumerate(sorted(str(i) for i in range(1500)))}


def test_bootstrap(spark):
    row = splits.bootstrap_counts(spark.range(50_000), "id").agg(F.avg("mult"), F.var_pop("mult"), F.max("mult")).first()
    assert row[0] == pytest.approx(1, abs=0.02) and row[1] == pytest.approx(1, abs=0.04) and row[2] < 12


@pytest.fixture(scope="module")
def vectors(spark):
    """600 vectors in 5 dimensions in clusters; a third are copies of one vector."""
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 5)) * 4
    x = centers[rng.integers(0, 6, 600)] + rng.normal(size=(600, 5))
    x[rng.random(600) < 0.33] = x[0]
    rows = [(i, v.tolist(), int(i % 3)) for i, v in enumerate(x)]
    return x, spark.createDataFrame(rows, "id long, vec array<double>, label int").repartition(5).persist()


def brute(x, probes, train, m, metric, p, exclude_self=False):
    out = []
    for a in probes:
        diff = x[train] - x[a]
        if metric == "euclid":
            d = np.sqrt((diff**2).sum(1))
        elif metric == "chebyshev":
            d = np.abs(diff).max(1)
        elif metric == "minkowski":
            d = (np.abs(diff) ** p).sum(1) ** (1 / p)
        else:
            u = x[train] / np.linalg.norm(x[train], axis=1, keepdims=True)
            d = ((u - x[a] / np.linalg.norm(x[a])) ** 2).sum(1) / 2
        pairs = sorted((round(float(v), 9), b) for v, b in zip(d, train) if not (exclude_self and a == b))
        out += [(a, r, b) for r, (_, b) in enumerate(pairs[:m], 1)]
    return sorted(out)


@pytest.mark.parametrize(("metric", "p"), [("euclid", 2), ("cosine", 2), ("chebyshev", 2), ("minkowski", 1), ("minkowski", 4)])
@pytest.mark.parametrize("pivots", [None, 12])
def test_nearest_is_exact(vectors, metric, p, pivots):
    x, df = vectors
    train, probe = df.filter("id < 450"), df.filter("id >= 450")
    near = N.nearest(train, probe, 7, id_col="id", vec_col="vec", metric=metric, p=p, pivots=pivots, rows_per_block=64)
    got = sorted((r["probe"], r["rank"], r["nb"]) for r in near.collect())
    assert got == brute(x, range(450, 600), range(450), 7, metric, p)


def test_nearest_without_self(vectors, partitions):
    x, df = vectors
    want = brute(x, range(600), range(600), 4, "euclid", 2, exclude_self=True)
    for got in partitions(
        lambda: sorted(
            (r["probe"], r["rank"], r["nb"])
            for r in N.nearest(df, df, 4, id_col="id", vec_col="vec", exclude_self=True, pivots=9, rows_per_block=50).collect()
        ),
        (1, 20),
    ):
        assert got == want


def test_cells_prune(vectors):
    """Clustered rows: a probe visits few of the cells."""
    _, df = vectors
    t = N._norm_step(df, "id", "vec", (), "euclid")
    centers = N._choose_pivots(t, 30)
    placed = N._assign_cells(t, centers, "euclid", 2)
    cells = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.max("_pd").alias("r")).collect()
    sizes, radii = np.zeros(30, dtype="int64"), np.zeros(30)
    for c in cells:
        sizes[c["_cell"]], radii[c["_cell"]] = c["n"], c["r"]
    visits = N._visits(t, centers, sizes, radii, 3, "euclid", 2).count()
    assert visits < 600 * 30 / 2


def test_neighbor_counts_and_votes(spark):
    """Fixed window: 3 fetched of n = 10, 2 vote. Relative window with k = 3: 4 fetched, 3 vote."""
    assert N.fixed_fetch(10) == 3 and N.fixed_fetch(1) == 0
    rows = [(1, 1, 10, 0.1, 2), (1, 2, 11, 0.2, 1), (1, 3, 12, 0.3, 2), (1, 4, 13, 0.4, 2)]
    near = spark.createDataFrame(rows, "probe int, rank int, nb int, dist double, label int")
    fixed = N.vote(near.filter("rank <= 3"), label="label", kernel="uniform", bandwidth=1.0)
    assert fixed.first()["pred"] == 1  # one vote each, the lower class wins
    assert N.vote(near, label="label", kernel="uniform", k=3).first()["pred"] == 2
    zero = N.vote(near, label="label", kernel="triangular", bandwidth=0.01)
    assert zero.first()["pred"] == 1  # no weight at all: the least class there is
    flat = near.withColumn("dist", F.lit(0.0))
    assert N.vote(flat, label="label", kernel="gaussian", k=3).first()["pred"] == 2
    exact = near.withColumn("dist", F.when(F.col("nb") == 11, 0.0).otherwise(F.col("dist")))
    assert N.distance_vote(exact, label="label", k=3).first()["pred"] == 1
    assert N.distance_vote(near, label="label", k=3, weights="uniform").first()["pred"] == 2


def test_zero_vector_does_not_stop_the_search(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "id long, vec array<double>")
    near = N.nearest(df, df, 2, id_col="id", vec_col="vec", metric="cosine").collect()
    assert {(r.probe, r.nb): r.dist for r in near} == {(1, 1): 1.0, (1, 2): 1.0, (2, 1): 1.0, (2, 2): 0.0}


def test_kernel_fold_blocks(vectors):
    x, df = vectors
    one = df.withColumn("w", F.lit(1.0) + F.col("label"))
    kernels = {"p": ("poly", 2.0), "l": ("linear", 0.0), "r": ("rbf", 0.05)}
    got = {r["id"]: r for r in N.kernel_fold(one, df, id_col="id", vec_col="vec", weight="w", kernels=kernels, rows_per_block=100).collect()}
    w = 1.0 + np.arange(600) % 3
    gram = x @ x.T
    sq = ((x[:, None] - x[None]) ** 2).sum(2)
    for name, want in {"p": gram**2 @ w, "l": gram @ w, "r": np.exp(-0.05 * sq) @ w}.items():
        assert [got[i][name] for i in range(600)] == pytest.approx(want)


@pytest.mark.parametrize("criterion", ["gini", "entropy", "log_loss"])
def test_split_scan_matches_numpy(spark, criterion):
    rng = np.random.default_rng(5)
    x, y, w = np.round(rng.normal(size=300), 1), rng.integers(0, 3, 300), rng.random(300)
    df = spark.createDataFrame([(float(a), int(b), float(c)) for a, b, c in zip(x, y, w)], "x double, y int, w double")

    def impurity(mask):
        p = np.array([w[mask & (y == c)].sum() for c in range(3)])
        p = p / p.sum()
        if criterion == "gini":
            return 1 - (p**2).sum()
        return -(p * (np.log2 if criterion == "entropy" else np.log)(p + 1e-9)).sum()

    every = np.ones(300, bool)
    best = (0.0, None)
    for a, b in zip(np.unique(x)[:-1], np.unique(x)[1:]):
        left = x < (a + b) / 2
        g = impurity(every) - w[left].sum() / w.sum() * impurity(left) - w[~left].sum() / w.sum() * impurity(~left)
        if round(g, 9) > round(best[0], 9):
            best = (g, (a + b) / 2)
    found = trees.split_candidates(df, [], [F.col("x")], "y", F.col("w"), criterion, [0, 1, 2])
    row = trees.best_splits(found, ["feature"]).first()
    assert (row["gain"], row["thr"]) == (pytest.approx(best[0]), pytest.approx(best[1]))


def test_tree_edges(spark):
    one_class = spark.createDataFrame([(1.0, 1), (2.0, 1)], "x double, y int")
    assert rows_of(trees.grow_tree(one_class, ["x"], "y", depth=3)) == [(1, None, None, 2, 1)]
    constant = spark.createDataFrame([(1.0, 0), (1.0, 1), (1.0, 1)], "x double, y int")
    assert rows_of(trees.grow_tree(constant, ["x"], "y", depth=3)) == [(1, None, None, 3, 1)]
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 0), (4.0, 1)], "x double, y int")
    assert trees.grow_tree(df, ["x"], "y", depth=1, min_leaf=2).count() == 1
    assert trees.grow_tree(df, ["x"], "y", depth=1, min_split=5).count() == 1
    tree = trees.grow_tree(df, ["x"], "y", depth=2)
    pred = trees.tree_predict(df, tree, 2)
    assert [r["pred"] for r in pred.orderBy("x").collect()] == [0, 0, 0, 1]
    with pytest.raises(ValueError):
        trees.grow_tree(df, ["x"], "y", depth=31)


def test_blocks_hold_neither_visits_nor_pairs(vectors):
    """No vector is written or sent once per probe and cell, and a block of probes keeps m rows however many stream past."""
    x, df = vectors
    t = N._norm_step(df, "id", "vec", (), "euclid")
    centers = N._choose_pivots(t, 12)
    visits = N._visits(t, centers, np.full(12, 50), np.full(12, 1e9), 3, "euclid", 2)
    assert visits.columns == ["_id", "_cell"] and visits.count() == 600 * 12
    lists, _ = N.block_lists(df, df, 5, id_col="id", vec_col="vec", exclude_self=True, rows_per_block=64, pivots=12)
    assert lists.count() == 600 and {len(r.dist) for r in lists.collect()} == {5}


def test_probe_blocks_are_bounded():
    counts = np.array([10, 500, 0, 30, 25, 40])
    first, parts, total = N._probe_blocks(counts, np.arange(12.0).reshape(6, 2), 64)
    assert parts[1] == 8 and total == 8 + 3
    held = [sum(int(n) for n, f in zip(counts, first) if f == b and n <= 64) for b in range(total)]
    assert max(held) <= 64 and sum(held) == 105


def test_probe_and_train_keys_of_other_types(spark):
    rows = [(2**60 + i, [float(i), 0.0], f"n{i}" if i else None) for i in range(9)]
    train = spark.createDataFrame(rows, "id long, v array<float>, name string")
    probe = train.selectExpr("concat('p', id) id", "v")
    near = N.nearest(train, probe, 2, id_col="id", vec_col="v", carry=["name"]).collect()
    assert len(near) == 18
    got = {r.probe: (r.nb, r.name, r.dist) for r in near if r["rank"] == 1}
    assert got == {f"p{i}": (i, n, 0.0) for i, _, n in rows}


def test_hashed_keys_are_not_sent_whole(vectors):
    """The exploded keys are joined by shuffles: no estimate of theirs decides on a broadcast by way of the driver."""
    _, df = vectors
    points = df.selectExpr("id AS _id", "cast(vec AS array<double>) AS _vec")
    plan = N.candidate_pairs(points, points, 8, 4, 4)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_pairs_are_met_in_blocks_and_shuffle_vectors_alone(spark, vectors, monkeypatch):
    """Blocks of train rows meet the pairs of the joined keys; neither keys nor pairs that are too far are shuffled."""
    _, df = vectors
    points = df.selectExpr("id AS _id", "cast(vec AS array<double>) AS _vec")
    monkeypatch.setattr(N, "TRAIN_BLOCK", 100)
    want = {tuple(r) for r in N.candidate_pairs(points, points, 8, 4, 4).collect()}
    for most in (1 << 24, 16):  # with and without a place for each bucket
        monkeypatch.setattr(N, "MAX_BUCKETS", most)
        got = [(r.probe, r.nb) for r in N.met_pairs(points, points, None, 8, 4, 4).collect()]
        assert len(got) == len(set(got)) and set(got) == want and 0 < len(want) < points.count() ** 2
    near = N.approximate_join(df, df, 0.5, id_col="id", vec_col="vec", bits=8, tables=4, probes=4)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "_table" not in plan and "_key" not in plan


def test_forward_steps_sum_no_former_directions(spark, monkeypatch):
    """The aggregate over all counts has the same number of sums in every step."""
    from lumenframe.operators import selection as S

    seen = []
    write = S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, tag="table": seen.append((tag, len(df.columns))) or write(df, tag))
    rng = np.random.default_rng(8)
    dense = rng.integers(0, 3, (60, 12))
    counts = spark.createDataFrame([(int(i), f"t{j:02d}", int(dense[i, j])) for i, j in zip(*np.nonzero(dense))], "id int, term string, cnt long")
    labels = spark.createDataFrame([(i, int(rng.integers(2))) for i in range(60)], "id int, q int")
    steps = S.forward_terms(counts, labels, "id", F.col("q") == 1, 9).orderBy("step").collect()
    assert {n for tag, n in seen if tag == "scores"} == {5} and len([1 for tag, _ in seen if tag == "scores"]) == 9
    y = np.array([1.0 if r.q == 1 else -1.0 for r in labels.orderBy("id").collect()])
    for step in range(1, 10):
        x = np.column_stack([np.ones(60), *[dense[:, int(r.term[1:])] for r in steps[:step]]])
        rest = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
        assert steps[step - 1].r2 == pytest.approx(1 - rest @ rest / ((y - y.mean()) @ (y - y.mean())))
