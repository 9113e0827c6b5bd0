"""Small inputs with answers worked out by hand."""

from __future__ import annotations

import datetime
import math

import pytest
from pyspark.sql import functions as F

from lumenframe.functions import impurity as I
from lumenframe.functions import kernels as K
from lumenframe.functions import scalars as S
from lumenframe.operators import linear as L
from lumenframe.operators import metrics as M
from lumenframe.operators import prep as P
from lumenframe.operators import profile as A
from lumenframe.operators import selection as Sel
from lumenframe.operators import series as Se
from lumenframe.operators import splits, trees


def values(df, order, *cols):
    return [tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.orderBy(order).collect()]


def test_kernels(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (2.0,)], "u double")
    want = {
        "uniform": [0.5, 0.5, 0, 0],
        "gaussian": [0.398942, 0.352065, 0.241971, 0.053991],
        "triangular": [1, 0.5, 0, 0],
        "epanechnikov": [0.75, 0.5625, 0, 0],
    }
    for name, fn in K.KERNELS.items():
        got = values(df.select("u", fn(F.col("u")).alias("k")), "u", "k")
        assert got == pytest.approx(want[name], abs=1e-6)


def test_vector_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "a array<double>, b array<double>")
    a, b = F.col("a"), F.col("b")
    row = df.select(
        K.minkowski(a, b), K.minkowski(a, b, 1), K.chebyshev(a, b), K.cosine_distance(a, b), K.polynomial_similarity(a, b, 2),
        K.rbf_similarity(a, b, 0.1), K.dot(a, b),
    ).first()
    cos = 16 / (math.sqrt(5) * math.sqrt(52))
    assert list(row) == pytest.approx([5, 7, 4, 1 - cos, 256, math.exp(-2.5), 16])
    zero = spark.createDataFrame([([0.0], [1.0])], "a array<double>, b array<double>")
    assert zero.select(K.cosine_distance(F.col("a"), F.col("b"))).first()[0] is None
    with pytest.raises(ValueError):
        K.minkowski(a, b, 0.5)


def test_regression_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0)], "r double, p double")
    row = M.regression_errors(df, "r", "p").first()
    assert list(row) == pytest.approx([0.666667, 0.416667, 31.746032, 0.071398, 0.159199], abs=1e-6)
    zero = spark.createDataFrame([(0.0, 0.0)], "r double, p double")
    assert M.regression_errors(zero, "r", "p").first()["smape"] == 0


def test_impurity(spark):
    row = spark.range(1).select(*[f([F.lit(2.0), F.lit(2.0)]) for f in (I.entropy, I.gini, I.log_loss)]).first()
    assert list(row) == pytest.approx([1, 0.5, 0.693147], abs=1e-6)


def test_best_split(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 1), (4.0, 1)], "x double, y int")
    found = trees.split_candidates(df, [], [F.col("x")], "y", F.lit(1.0), "gini", [0, 1])
    row = trees.best_splits(found, ["feature"]).first()
    assert (row["thr"], row["gain"]) == (2.5, pytest.approx(0.5))


def test_samme_round(spark):
    df = spark.createDataFrame([(i, 0 if i else 1, 0, 0.2) for i in range(5)], "id int, y int, p int, w double")
    error = trees.weighted_error(df, "y", "p", "w")
    alpha = trees.samme_alpha(error, 3)
    assert alpha == pytest.approx(2.079442, abs=1e-6)
    w = values(trees.samme_reweight(df, "y", "p", "w", alpha), "id", "w")
    assert w == pytest.approx([0.666667] + [0.083333] * 4, abs=1e-6)


def test_ridge(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (2.0, 5.0)], "x double, y double")
    assert list(L.ridge(df, ["x"], "y", 0).values()) == pytest.approx([1, 2])
    assert list(L.ridge(df, ["x"], "y", 1).values()) == pytest.approx([1, 1.666667], abs=1e-6)


def term_fixture(spark, counts):
    rows = [(i, "t", c) for i, c in enumerate(counts) if c]
    labels = [(i, y) for i, y in enumerate([0, 0, 1, 1])]
    return spark.createDataFrame(rows, "id int, term string, cnt long"), spark.createDataFrame(labels, "id int, y int")


def test_term_scores(spark):
    counts, labels = term_fixture(spark, [2, 0, 1, 3])
    assert Sel.chi2_scores(counts, labels, "id", "y").first()["score"] == pytest.approx(0.666667, abs=1e-6)
    counts, labels = term_fixture(spark, [1, 0, 1, 1])
    assert Sel.mutual_info_scores(counts, labels, "id", "y").first()["score"] == pytest.approx(0.215762, abs=1e-6)
    scores = Sel.variance_scores(counts, labels, "id")
    assert scores.first()["score"] == pytest.approx(0.1875)
    assert Sel.variance_select(scores, 0.9, 5).count() == 1
    assert Sel.variance_select(scores, 0.5, 5).count() == 0
    with pytest.raises(ValueError):
        Sel.variance_select(scores, 1.5, 5)


def series(spark, ys):
    rows = [("a", datetime.date(2024, 1, 1) + datetime.timedelta(days=i), float(y)) for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "k string, d date, y double")


def test_autocorrelation(spark):
    got = values(Se.autocorrelation(series(spark, [1, 2, 4, 3, 5]), ["k"], "d", "y", 2), "lag", "r")
    assert got == pytest.approx([1, 0.1, 0], abs=1e-9)


def test_decompose(spark):
    got = values(Se.decompose(series(spark, [1, 2, 4, 3, 5]), ["k"], "d", "y", 2), "d", "trend")
    assert got == [None, 2.25, 3.25, 3.75, None]
    odd = values(Se.decompose(series(spark, [3, 6, 9, 12]), ["k"], "d", "y", 3), "d", "trend")
    assert odd == [None, 6, 9, None]


def test_compound_bins(spark):
    df = spark.createDataFrame([(-1.0,), (-0.4,), (-0.39,), (0.5,), (0.51,), (1.0,)], "x double")
    names = ("negative", "neutral", "positive")
    label = S.cut_right(F.col("x"), (-1.0, -0.4, 0.5, 1.0), names)
    rows = df.select("x", label.alias("l")).select("x", "l", S.category_code(F.col("l"), names).alias("c"))
    assert values(rows, "x", "l", "c") == [
        (None, -1), ("negative", 0), ("neutral", 1), ("neutral", 1), ("positive", 2), ("positive", 2)
    ]


def test_compound(spark):
    from lumenframe.operators import text as T

    docs = spark.createDataFrame([(1, "good"), (2, "Bad!"), (3, "none here"), (4, ""), (5, "not good"), (6, "very bad")], "id int, text string")
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "word string, valence double")
    modifiers = spark.createDataFrame([("not", "negation"), ("very", "booster")], "word string, kind string")
    got = values(T.sentiment(docs, "id", "text", lexicon, modifiers), "id", "compound")

    def squash(s):
        return s / math.sqrt(s * s + 15)

    assert got == pytest.approx([0.4404, -0.5423, 0, 0, squash(-0.74 * 1.9), squash(-2.793)], abs=1e-4)


def test_inverse_diff(spark):
    df = series(spark, [2, 3, 2, 5]).withColumn("s", F.lit(2.0))
    diffs = Se.difference(df, ["k"], "d", "y", 1, "dy")
    assert values(Se.inverse_diff(diffs, ["k"], "d", "dy", "s", 1, "lv"), "d", "lv") == [2, 3, 2, 5]


def test_shift_crop(spark):
    df = series(spark, [1, 2, 3])
    assert values(Se.shift(df, ["k"], "d", "y", 1, "s"), "d", "s") == [None, 1, 2]
    assert values(Se.shift(df, ["k"], "d", "y", 1, "s", crop=True), "d", "s") == [1, 2]


def test_zscore(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 4.0)], "id int, x double")
    assert values(A.zscore(df, [], "x"), "id", "z") == pytest.approx([-1.069045, -0.267261, 1.336306], abs=1e-6)
    flat = spark.createDataFrame([(1, "a", 5.0), (2, "a", 5.0)], "id int, k string, x double")
    assert values(A.zscore(flat, ["k"], "x"), "id", "z") == [None, None]


def test_classification(spark):
    df = spark.createDataFrame(list(zip([0, 0, 1, 1, 2], [0, 1, 1, 1, 2])), "t int, p int")
    report = {r["class"]: r for r in M.classification_report(df, "t", "p").collect()}
    assert report["weighted"]["f1"] == pytest.approx(0.786667, abs=1e-6)
    assert M.holdout_scores(df, "t", "p").first()["f1"] == pytest.approx(0.786667, abs=1e-6)
    assert M.accuracy(df, "t", "p").first()["accuracy"] == 80
    binary = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1)], "t int, p int")
    assert M.binary_f1(binary, "t", "p").first()[0] == 0.5
    assert list(M.binary_scores(binary, "t", "p").first()) == [50, 0.5, 0.5]


def test_roc_auc(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, s double")
    assert M.roc_auc(df, "y", "s").first()[0] == pytest.approx(0.75)
    assert M.roc_auc(df.filter("y = 1"), "y", "s").first()[0] is None


def test_resample(spark):
    day = datetime.datetime(2024, 1, 1)
    rows = [("a", day + datetime.timedelta(days=d), i, float(d)) for i, d in enumerate((0, 3, 15))]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, id int, y double")
    assert values(Se.resample_first(df, ["k"], "t", "id", "y", 7), "bin_start", "first") == [0, None, 15]


def test_encodings(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "c"), (5, None)], "id int, v string")
    codes = {r["v"]: r["code"] for r in P.label_codes(df, "v").collect()}
    assert codes == {"a": 0, "b": 1, "c": 2}
    assert values(P.label_encode(df, "v"), "id", "code") == [1, 0, 1, 2, None]
    assert {r["v"]: r["ord"] for r in P.first_seen_codes(df, "v", ["id"]).collect()} == {"b": 1, "a": 2, "c": 3}
    hot = P.one_hot(spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, v string"), "v")
    assert values(hot, "id", "v_a", "v_b") == [(1, 0), (0, 0), (0, 1)]
    assert P.one_hot(df, "v", drop_first=True).columns == ["id", "v_b", "v_c"]
    assert P.string_columns(df) == ["v"]
    with pytest.raises(ValueError):
        P.categories(df, "v", 2)
    with pytest.raises(ValueError):
        P.drop_columns(df, "missing")
    with pytest.raises(ValueError):
        P.numeric_column(df, "v")


def test_recode(spark):
    df = spark.createDataFrame([("a",), ("z",)], "v string")
    assert values(P.recode(df, "v", {"a": "x"}, "g"), "v", "g") == ["x", None]


def test_dates(spark):
    df = spark.createDataFrame([(1, "5 марта 2024"), (2, "5 brumaire 2024"), (3, "x"), (4, None)], "id int, t string")
    assert values(df.select("id", S.parse_month_name_date(F.col("t")).alias("d")), "id", "d") == [
        datetime.date(2024, 3, 5), None, None, None
    ]
    day = spark.createDataFrame([(1, datetime.date(2024, 3, 5)), (2, None)], "id int, d date")
    assert values(day.select("id", S.unpadded_date(F.col("d")).alias("s")), "id", "s") == ["5.3.2024", "-"]
    bad = spark.createDataFrame([("05.03.2024",), ("5/3/24",)], "t string").select("t", S.parse_date(F.col("t")).alias("d"))
    assert values(bad, "t", "d") == [datetime.date(2024, 3, 5), None]


def test_progress(spark):
    rows = [
        (1, S.FINISHED, None),
        (2, "open", "background: linear-gradient(to right, #a 0%, #a 42%, #b 42%, #b 100%)"),
        (3, "open", "background: none"),
        (4, None, None),
    ]
    df = spark.createDataFrame(rows, "id int, s string, st string")
    assert values(df.select("id", S.progress(F.col("s"), F.col("st")).alias("p")), "id", "p") == [1.0, 0.42, 0.0, 0.0]


def test_ordered_holdout(spark):
    parts = values(splits.holdout_ordered(spark.range(11), "id", 0.2), "id", "part")
    assert parts == ["train"] * 8 + ["test"] * 3


def test_date_window_checks(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 1),), (datetime.date(2024, 2, 1),)], "d date")
    assert splits.date_window(df, "d", period_days=5).count() == 1
    with pytest.raises(ValueError):
        splits.date_window(df, "d", datetime.date(2024, 1, 2), datetime.date(2024, 1, 1))
    with pytest.raises(ValueError):
        splits.date_window(df, "d")


def test_delimited_text(spark, tmp_path):
    from lumenframe.sources.delimited import read_delimited, write_delimited

    df = spark.createDataFrame([(1, 'say "hi"; now'), (2, "two\nlines"), (3, "  é  "), (4, None)], "id int, t string")
    write_delimited(df, str(tmp_path / "out"), ";")
    back = read_delimited(spark, str(tmp_path / "out"), "id int, t string", ";", multi_line=True)
    assert values(back, "id", "t") == ['say "hi"; now', "two\nlines", "  é  ", None]


def test_text_cleaning(spark):
    from lumenframe.operators import text as T

    df = spark.createDataFrame([(1, "The  cats are THE best\n"), (2, "")], "id int, t string")
    assert values(df.select("id", T.strip_stopwords(F.col("t"), ["the"]).alias("s")), "id", "s") == ["cats are best", ""]
    lemmas = spark.createDataFrame([("cats", "cat"), ("are", "be")], "form string, lemma string")
    assert values(T.lemmatize(df, "id", "t", lemmas), "id", "lemmas", "n_changed") == [("The cat be THE best", 2), ("", 0)]


def test_encode_ids(spark):
    from lumenframe.operators import text as T

    df = spark.createDataFrame([(1, "b a b zz b"), (2, "")], "id int, t string")
    ids = T.frequent_ids(df, "t", 2)
    assert values(ids, "id", "term", "id") == [("b", 4), ("a", 5)]
    rows = [tuple(r) for r in T.encode_ids(df, "id", "t", ids, 5).orderBy("id", "block").collect()]
    assert rows == [
        (1, 0, [2, 4, 5, 4, 3], [1, 1, 1, 1, 1]),
        (1, 1, [2, 1, 4, 3, 0], [1, 1, 1, 1, 0]),
        (2, 0, [2, 3, 0, 0, 0], [1, 1, 0, 0, 0]),
    ]


def test_encode_ids_of_a_long_text(spark):
    """60,000 different words in one text: their lookup is not a scan of all of them for each word."""
    import time

    from lumenframe.operators import text as T

    long = " ".join(f"w{i}" for i in range(60000)) + " w5 new"
    df = spark.createDataFrame([(1, long), (2, None), (3, "new")], "id int, t string")
    ids = spark.createDataFrame([(f"w{i}", 10 + i) for i in range(60000)] + [(None, 7)], "term string, id long")
    start = time.time()
    rows = {(r.id, r.block): r.ids for r in T.encode_ids(df, "id", "t", ids, 1002).collect()}
    assert time.time() - start < 40
    assert len(rows) == 63 and rows[2, 0][:3] == [2, 3, 0] and rows[3, 0][:4] == [2, 1, 3, 0]
    assert [i for b in range(61) for i in rows[1, b][1:1001]][:60004] == [*range(10, 60010), 15, 1, 3, 0]
