"""Estimator queries on the document shapes and the selected terms (no SQL form: iterative fits)."""

from __future__ import annotations

import json
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.functions import scalars
from lumenframe.operators import models as M
from lumenframe.operators import selection as Sel
from lumenframe.operators import tuning
from lumenframe.operators import wrappers as W
from lumenframe.operators.metrics import binary_f1, classification_report, holdout_scores
from lumenframe.operators.splits import holdout_hashed
from lumenframe.operators.term_models import softmax_fit, softmax_predict
from lumenframe.operators.term_trees import term_importances
from lumenframe.operators.text import inverse_document_frequency, term_counts
from lumenframe.plans.features import SHAPE, doc_shape_scaled, texts
from lumenframe.plans.prep import round_doubles
from lumenframe.plans.registry import query
from lumenframe.plans.text import EDGES, LABELS, TOK_SQL, TOP, VARIANCE_P, compounds, counted, train_part
from lumenframe.sources.scratch import materialize

# rounds of the boosting and trees of the forest; the tolerance ends the text classifier well before this
ROUNDS, FOREST, CLASSIFIER_ITERATIONS = 50, 100, 1000
# trials of a search, and the values of a sweep
TRIALS = 100
# share of the terms that a fit of the recursive elimination drops; steps of the forward selection that the SQL states
RFE_SHARE, FORWARD = 0.5, 30
DEPTHS = range(1, 31)


def shape_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = M.assemble(holdout_hashed(doc_shape_scaled(spark, sf), "doc_id", 75), SHAPE, "quality", ["doc_id", "part"])
    return rows.filter("part = 'train'"), rows.filter("part = 'test'")


@query("linear_models_compare")
def linear_models_compare(spark, sf):
    train, test = shape_parts(spark, sf)
    predictions = {
        "logistic": M.logistic(elasticNetParam=0.5, regParam=0.01).fit(train).transform(test),
        "linear_svm": M.linear_svm(train.count()).fit(train).transform(test),
        "squared": M.squared_loss_predict(M.squared_loss_fit(train), test),
    }
    return round_doubles(M.score_models(predictions))


@query("tree_fit")
def tree_fit(spark, sf):
    train, test = shape_parts(spark, sf)
    predictions = {c: M.tree(5, c, min_leaf=2).fit(train).transform(test) for c in ("gini", "entropy")}
    return round_doubles(M.score_models(predictions))


@query("forest_fit")
def forest_fit(spark, sf):
    train, test = shape_parts(spark, sf)
    predictions = {s: M.forest(FOREST, 5, s).fit(train).transform(test) for s in ("all", "sqrt", "log2")}
    return round_doubles(M.score_models(predictions))


@query("samme_fit")
def samme_fit(spark, sf):
    train, test = shape_parts(spark, sf)
    models, alphas, classes = M.samme_fit(train, ROUNDS)
    return round_doubles(M.score_models({f"samme_{len(models)}": M.samme_predict(test, models, alphas, classes)}))


@query("depth_sweep")
def depth_sweep(spark, sf):
    """Every tree depth, and every forest size from 1 to FOREST by the prefixes of one forest."""
    train, test = shape_parts(spark, sf)
    results = tuning.run_trials(train, test, lambda p: M.tree(p["depth"]), [{"depth": d} for d in DEPTHS])
    depths = spark.createDataFrame([("tree", p["depth"], a, f) for p, a, f in results], "model string, value int, accuracy double, f1 double")
    sizes = M.forest_prefixes(M.forest(FOREST).fit(train), test, "doc_id")
    scored = holdout_scores(sizes, "label", "prediction", ["size"])
    return round_doubles(depths.unionByName(scored.select(F.lit("forest").alias("model"), F.col("size").alias("value"), "accuracy", "f1")))


@query("holdout_search")
def holdout_search(spark, sf):
    """Random search over models and their parameters, on a validation part cut from the train rows."""
    train, _ = shape_parts(spark, sf)
    inner = holdout_hashed(train.drop("part"), "doc_id", 80, seed=43)
    fit_rows = inner.filter("part = 'train'")
    n = fit_rows.count()
    space = {
        "model": tuning.Choice(("tree", "forest", "logistic", "linear_svm")), "depth": tuning.IntRange(1, 8), "trees": tuning.IntRange(1, 20),
        "min_leaf": tuning.IntRange(1, 10), "criterion": tuning.Choice(("gini", "entropy")), "penalty": tuning.FloatRange(0.0, 0.2),
    }

    def build(p):
        if p["model"] == "tree":
            return M.tree(p["depth"], p["criterion"], p["min_leaf"])
        if p["model"] == "forest":
            return M.forest(p["trees"], p["depth"], "sqrt", p["criterion"])
        return M.logistic(regParam=p["penalty"]) if p["model"] == "logistic" else M.linear_svm(n, 1 / (p["penalty"] * n + 1e-3))

    trials = tuning.draws(space, TRIALS, seed=42)
    results = tuning.run_trials(fit_rows, inner.filter("part = 'test'"), build, trials)
    best = tuning.best_trial(results)
    rows = [(i, json.dumps(p), a, f, i == best) for i, (p, a, f) in enumerate(results)]
    return round_doubles(spark.createDataFrame(rows, "trial int, params string, accuracy double, f1 double, best boolean"))


@query("metric_search")
def metric_search(spark, sf):
    """Tree depths by a metric of the caller: F1 of class 1."""
    train, test = shape_parts(spark, sf)
    trials = [{"depth": d} for d in range(1, 11)]
    results = tuning.run_trials(train, test, lambda p: M.tree(p["depth"]), trials, metric=binary_f1)
    best = tuning.best_trial(results)
    rows = [(p["depth"], a, f, i == best) for i, (p, a, f) in enumerate(results)]
    return round_doubles(spark.createDataFrame(rows, "depth int, accuracy double, f1 double, best boolean"))


def term_parts(spark, sf):
    """(terms, train vectors, test vectors, train counts, train labels) over the whole train vocabulary."""
    counts, labels = counted(spark, sf)
    train_counts, train = train_part(counts, labels)
    terms = M.vocabulary_list(train_counts, "term")
    rows = labels.select("doc_id", F.col("quality").cast("double").alias("label"), "part")
    rows = M.count_vectors(rows, counts, "doc_id", len(terms))
    return terms, rows.filter("part = 'train'"), rows.filter("part = 'test'"), train_counts, train


@query("rfe_select")
def rfe_select(spark, sf):
    terms, train, *_ = term_parts(spark, sf)
    left = W.rfe_select(train, len(terms), TOP, step=RFE_SHARE)
    rows = [(terms[i], r) for r, i in enumerate(left, 1)]
    return spark.createDataFrame(rows, "term string, rank int")


def forward_sql() -> str:
    parts = [f"""WITH {TOK_SQL}
t AS MATERIALIZED (SELECT doc_id, term, cnt::DOUBLE AS x FROM tc WHERE train),
n AS MATERIALIZED (SELECT count(*)::DOUBLE AS n, avg(CASE quality WHEN 1 THEN 1.0 ELSE -1.0 END) AS m FROM lab WHERE train),
d0 AS MATERIALIZED (SELECT doc_id, CASE quality WHEN 1 THEN 1.0 ELSE -1.0 END - m AS r FROM lab, n WHERE train)"""]
    for k in range(1, FORWARD + 1):
        old = range(1, k)
        cross = "".join(f", sum(x * q{i}) AS c{i}" for i in old)
        rest = "sum(x * x) - pow(sum(x), 2) / any_value(n)" + "".join(f" - pow(sum(x * q{i}), 2)" for i in old)
        gone = "".join(f" - b.c{i} * q{i}" for i in old)
        parts.append(f"""b{k} AS MATERIALIZED (SELECT * FROM (SELECT term, sum(x) AS s, sum(x * r) AS num, sum(x * x) AS sq, {rest} AS den{cross}
  FROM t JOIN d{k - 1} USING (doc_id), n GROUP BY term) WHERE den > 1e-9 * sq ORDER BY round(num * num / den, 9) DESC, term LIMIT 1),
d{k} AS MATERIALIZED (SELECT * EXCLUDE (num, den) REPLACE (r - num / sqrt(den) * q{k} AS r) FROM (
  SELECT d.*, b.num, b.den, (coalesce(t.x, 0) - b.s / n{gone}) / sqrt(b.den) AS q{k}
  FROM d{k - 1} d CROSS JOIN b{k} b CROSS JOIN n LEFT JOIN t ON t.doc_id = d.doc_id AND t.term = b.term))""")
    rows = " UNION ALL ".join(f"SELECT {k} AS step, (SELECT term FROM b{k}) AS term, (SELECT sum(r * r) FROM d{k}) AS sse" for k in range(1, FORWARD + 1))
    return ",\n".join(parts) + f"""
SELECT step::INT AS step, term, round(1 - sse / (SELECT sum(r * r) FROM d0), 6) AS r2 FROM ({rows})"""


@query("forward_select", forward_sql())
def forward_select(spark, sf):
    """Each step takes the term of all that explains most of what is left of the class."""
    counts, train = train_part(*counted(spark, sf))
    return round_doubles(Sel.forward_terms(counts, train, "doc_id", F.col("quality") == 1, FORWARD))


@query("importance_select")
def importance_select(spark, sf):
    counts, train = train_part(*counted(spark, sf))
    return round_doubles(Sel.top_terms(term_importances(counts, train, "doc_id", "quality", W.IMPORTANCE_TREES), TOP))


@query("select_then_score")
def select_then_score(spark, sf):
    """Scores of classifiers on all terms, and on TOP of them as chosen by every selector from all terms."""
    terms, train, test, counts, labels = term_parts(spark, sf)
    index = {t: i for i, t in enumerate(terms)}

    def indices(chosen):
        return [index[r["term"]] for r in chosen.select("term").collect()]

    importance = W.importances(train)
    selections = {
        "none": None,
        "chi2": indices(Sel.top_terms(Sel.chi2_scores(counts, labels, "doc_id", "quality"), TOP)),
        "mutual_info": indices(Sel.top_terms(Sel.mutual_info_scores(counts, labels, "doc_id", "quality"), TOP)),
        "variance": indices(Sel.variance_select(Sel.variance_scores(counts, labels, "doc_id"), VARIANCE_P, TOP)),
        "rfe": W.rfe_select(train, len(terms), TOP, step=RFE_SHARE),
        "forward": indices(Sel.forward_terms(counts, labels, "doc_id", F.col("quality") == 1, TOP)),
        "importance": sorted(range(len(terms)), key=lambda i: -importance[i])[:TOP],
    }
    classifiers = {"naive_bayes": M.naive_bayes(), "logistic": M.logistic(regParam=0.01), "tree": M.tree(), "linear_svm": M.linear_svm(train.count())}
    rows = W.effect_of_selection(train, test, selections, classifiers)
    return round_doubles(spark.createDataFrame(rows, "selector string, model string, accuracy double, f1 double, auc double"))


@query("text_classifier")
def text_classifier(spark, sf):
    """Sentiment class from weights of all train terms by a multinomial linear model; report on the holdout."""
    label = scalars.category_code(scalars.cut_right(F.col("compound"), EDGES, LABELS), LABELS)
    classes = compounds(spark, sf).select("doc_id", label.cast("double").alias("label")).filter("label >= 0")
    docs = holdout_hashed(materialize(texts(spark, sf).join(classes, "doc_id"), "classed"), "doc_id", 70)
    labels = docs.select("doc_id", "label", "part")
    counts = materialize(term_counts(docs, "doc_id", "text", 1), "counts").join(labels.select("doc_id", "part"), "doc_id")
    train = labels.filter("part = 'train'").select("doc_id", "label")
    idf = materialize(inverse_document_frequency(counts.filter("part = 'train'"), train.count()), "idf")
    values = counts.join(idf, "term").select("doc_id", "part", "term", (F.col("cnt") * F.col("idf")).alias("value"))
    model = softmax_fit(values.filter("part = 'train'"), train, "doc_id", "label", 0.01, max_iter=CLASSIFIER_ITERATIONS)
    if model.iterations >= CLASSIFIER_ITERATIONS:
        warnings.warn(f"classifier stopped after {CLASSIFIER_ITERATIONS} iterations", RuntimeWarning, stacklevel=2)
    scored = softmax_predict(model, values.filter("part = 'test'"), labels.filter("part = 'test'"), "doc_id")
    return round_doubles(classification_report(scored.select(F.col("label").cast("int").alias("t"), F.col("prediction").cast("int").alias("p")), "t", "p"))
