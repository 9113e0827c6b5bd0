"""Votes, scores and losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions.impurity import CRITERIA
from lumenframe.functions.losses import LOSSES
from lumenframe.operators import metrics as M
from lumenframe.operators import trees
from lumenframe.operators.linear import linear_score
from lumenframe.plans.features import DOCZ_SQL, SHAPE, doc_shape, doc_shape_scaled
from lumenframe.plans.prep import round_doubles
from lumenframe.plans.registry import query
from lumenframe.sources.scratch import materialize
from lumenframe.sources.tables import table

# a fixed linear score, to evaluate the losses at
WEIGHTS = dict(zip(SHAPE, (0.5, -0.25, 0.25, 0.1)))

VOTE_SQL = """
voted AS (SELECT user_id, voted_type FROM (
    SELECT user_id, event_type AS voted_type,
           row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
    FROM events GROUP BY user_id, event_type) WHERE rn = 1)"""


@query("majority_vote", f"WITH {VOTE_SQL} SELECT user_id, voted_type FROM voted")
def majority_vote(spark, sf):
    return M.majority_vote(table(spark, sf, "events"), ["user_id"], "event_type", "voted_type")


def voted_events(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type")
    votes = M.majority_vote(events, ["user_id"], "event_type", "voted_type")
    return events.join(materialize(votes, "votes"), "user_id")


@query("classification_scores", f"""WITH {VOTE_SQL}
SELECT count(*) AS n, round(100.0 * avg((event_type = voted_type)::INT), 6) AS accuracy FROM events JOIN voted USING (user_id)
""")
def classification_scores(spark, sf):
    return round_doubles(M.accuracy(voted_events(spark, sf), "event_type", "voted_type"))


@query("classification_report", f"""WITH {VOTE_SQL},
j AS (SELECT event_type AS t, voted_type AS p FROM events JOIN voted USING (user_id)),
c AS (SELECT class, count(*) FILTER (t = class AND p = class) AS tp, count(*) FILTER (t = class) AS support,
             count(*) FILTER (p = class) AS predicted
      FROM j, (SELECT DISTINCT event_type AS class FROM events) GROUP BY class),
s AS (SELECT class, coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall,
             coalesce(2 * tp / nullif(predicted + support, 0), 0) AS f1, support FROM c)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM s
UNION ALL
SELECT 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM s
""")
def classification_report(spark, sf):
    return round_doubles(M.classification_report(voted_events(spark, sf), "event_type", "voted_type"))


@query("roc_auc", """
WITH s AS (SELECT quality, n_chars FROM documents JOIN labels USING (doc_id)),
r AS (SELECT quality, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS mid FROM s),
h AS (SELECT quality, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS hard FROM s)
SELECT 'score' AS kind, round((sum(mid) FILTER (quality = 1) - p * (p + 1) / 2.0) / (p * q), 6) AS auc
FROM r, (SELECT count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality = 0) AS q FROM s) GROUP BY p, q
UNION ALL
SELECT 'hard', round((avg(hard) FILTER (quality = 1) + 1 - avg(hard) FILTER (quality = 0)) / 2, 6) FROM h
""")
def roc_auc(spark, sf):
    rows = doc_shape(spark, sf).select("quality", "n_chars")
    hard = rows.withColumn("hard", F.when(F.col("n_chars") >= 1000, 1).otherwise(0))
    score = M.roc_auc(rows, "quality", "n_chars").select(F.lit("score").alias("kind"), "auc")
    return round_doubles(score.unionByName(M.roc_auc(hard, "quality", "hard").select(F.lit("hard").alias("kind"), "auc")))


def group_means(spark, sf, key):
    part = table(spark, sf, "part").select(key, "p_retailprice")
    means = part.groupBy(key).agg(F.avg("p_retailprice").alias("pred"))
    return part.join(materialize(means, "means"), key).select("p_retailprice", "pred")


def errors_sql(key: str, model: str) -> str:
    return f"""SELECT '{model}' AS model, round(avg(abs(r - p)), 6) AS mae, round(avg(abs(r - p) / abs(r)), 6) AS mape,
       round(100 * avg(2 * abs(r - p) / (abs(r) + abs(p))), 6) AS smape, round(avg(pow(ln(1 + r) - ln(1 + p), 2)), 6) AS msle,
       round(2 * avg(ln(p / r) + r / p - 1), 6) AS gdev
FROM (SELECT p_retailprice AS r, avg(p_retailprice) OVER (PARTITION BY {key}) AS p FROM part)"""


@query("regression_errors", errors_sql("p_type", "type"))
def regression_errors(spark, sf):
    rows = group_means(spark, sf, "p_type").withColumn("model", F.lit("type"))
    return round_doubles(M.regression_errors(rows, "p_retailprice", "pred", ["model"]))


@query("model_compare", errors_sql("p_type", "type") + " UNION ALL " + errors_sql("p_brand", "brand"))
def model_compare(spark, sf):
    models = [group_means(spark, sf, k).withColumn("model", F.lit(n)) for k, n in (("p_type", "type"), ("p_brand", "brand"))]
    return round_doubles(M.regression_errors(models[0].unionByName(models[1]), "p_retailprice", "pred", ["model"]))


Z_SQL = " + ".join(f"{w} * {c}" for c, w in WEIGHTS.items())
SCORED_SQL = f"""WITH {DOCZ_SQL},
s AS (SELECT *, {Z_SQL} AS z, 2 * quality - 1 AS y, 1 / (1 + exp(-({Z_SQL}))) AS q FROM docz)"""


def scored(spark, sf):
    rows = doc_shape_scaled(spark, sf)
    return rows.select(*SHAPE, linear_score(WEIGHTS).alias("z"), "quality", (F.col("quality") * 2 - 1).alias("sign"))


def targets():
    return {n: F.col("quality" if n == "cross_entropy" else "sign").cast("double") for n in LOSSES}


@query("loss_values", SCORED_SQL + """
SELECT 'squared' AS loss, round(avg(pow(z - y, 2)), 6) AS value FROM s
UNION ALL SELECT 'cross_entropy', round(-avg(quality * ln(q) + (1 - quality) * ln(1 - q)), 6) FROM s
UNION ALL SELECT 'hinge', round(avg(greatest(1 - y * z, 0)), 6) FROM s
UNION ALL SELECT 'hinge_of_mean', round(greatest(avg(1 - y * z), 0), 6) FROM s
""")
def loss_values(spark, sf):
    y = targets()
    row = scored(spark, sf).agg(*[loss.value(y[n], F.col("z")).alias(n) for n, loss in LOSSES.items()])
    return round_doubles(row.unpivot([], list(LOSSES), "loss", "value"))


@query("loss_gradient", SCORED_SQL + " UNION ALL ".join(
    f"""
SELECT 'squared' AS loss, '{c}' AS feature, round(2 * avg((z - y) * {c}), 6) AS grad FROM s
UNION ALL SELECT 'cross_entropy', '{c}', round(avg((q - quality) * {c}), 6) FROM s
UNION ALL SELECT 'hinge', '{c}', round(avg(CASE WHEN y * z < 1 THEN -y * {c} ELSE 0 END), 6) FROM s
UNION ALL SELECT 'hinge_of_mean', '{c}', round(CASE WHEN avg(1 - y * z) > 0 THEN sum(-y * {c}) ELSE 0 END, 6) FROM s"""
    for c in SHAPE
))
def loss_gradient(spark, sf):
    y = targets()
    cells = [
        F.struct(F.lit(n).alias("loss"), F.lit(c).alias("feature"), loss.gradient(y[n], F.col("z"), F.col(c)).alias("grad"))
        for n, loss in LOSSES.items()
        for c in SHAPE
    ]
    rows = scored(spark, sf).agg(F.array(*cells).alias("cells"))
    return round_doubles(rows.select(F.inline("cells")))


SHARE_SQL = """WITH s AS (SELECT quality AS class, sum(n_chars) / sum(sum(n_chars)) OVER () AS share
FROM documents JOIN labels USING (doc_id) GROUP BY quality) """


@query("class_shares", SHARE_SQL + "SELECT class, round(share, 6) AS share FROM s")
def class_shares(spark, sf):
    return round_doubles(trees.class_shares(doc_shape(spark, sf), "quality", "n_chars"))


@query("impurity", SHARE_SQL + """
SELECT round(-sum(share * log2(share + 1e-9)), 6) AS entropy, round(1 - sum(share * share), 6) AS gini,
       round(-sum(share * ln(share + 1e-9)), 6) AS log_loss FROM s
""")
def impurity(spark, sf):
    sums = doc_shape(spark, sf).agg(
        *[F.sum(F.when(F.col("quality") == c, F.col("n_chars")).otherwise(0.0)).alias(f"w{c}") for c in (0, 1)]
    )
    return round_doubles(sums.select(*[f([F.col("w0"), F.col("w1")]).alias(n) for n, f in CRITERIA.items()]))
