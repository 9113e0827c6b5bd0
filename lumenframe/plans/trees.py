"""Exact split scan, tree and boosting round on the document shapes; gini, every row weight 1."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.operators import trees as T
from lumenframe.plans.features import DOCX_SQL, SHAPE, doc_shape
from lumenframe.plans.prep import round_doubles
from lumenframe.plans.registry import query


def gini(a: str, b: str) -> str:
    return f"(1 - pow({a} / ({a} + {b}), 2) - pow({b} / ({a} + {b}), 2))"


def scan_sql(rows: str, p: str) -> str:
    """CTEs ``{p}cand``: all split candidates of every node of ``rows``."""
    long = " UNION ALL ".join(f"SELECT node, {i} AS feature, {c} AS value, quality FROM {rows}" for i, c in enumerate(SHAPE))
    return f"""
{p}agg AS (SELECT node, feature, value, (count(*) FILTER (quality = 0))::DOUBLE AS w0, (count(*) FILTER (quality = 1))::DOUBLE AS w1
           FROM ({long}) GROUP BY node, feature, value),
{p}scan AS (SELECT node, feature, value, sum(w0) OVER w AS l0, sum(w1) OVER w AS l1, lead(value) OVER w AS nxt,
                   sum(w0) OVER t - sum(w0) OVER w AS r0, sum(w1) OVER t - sum(w1) OVER w AS r1
            FROM {p}agg WINDOW w AS (PARTITION BY node, feature ORDER BY value), t AS (PARTITION BY node, feature)),
{p}cand AS (SELECT node, feature, (value + nxt) / 2 AS thr,
                   {gini('(l0 + r0)', '(l1 + r1)')} - (l0 + l1) / (l0 + l1 + r0 + r1) * {gini('l0', 'l1')}
                   - (r0 + r1) / (l0 + l1 + r0 + r1) * {gini('r0', 'r1')} AS gain
            FROM {p}scan WHERE nxt IS NOT NULL),
{p}best AS (SELECT * FROM {p}cand WHERE round(gain, 9) > 0
            QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 9) DESC, feature, thr) = 1)"""


NAME = "['" + "', '".join(SHAPE) + "']"
VALUE = "[" + ", ".join(SHAPE) + "]"
ROOT = f"WITH {DOCX_SQL}, r0 AS (SELECT *, 1 AS node FROM docx),"


@query("tree_best_split", ROOT + scan_sql("r0", "a") + f"""
SELECT {NAME}[feature + 1] AS feature, round(thr, 6) AS thr, round(gain, 6) AS gain FROM acand WHERE round(gain, 9) > 0
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(gain, 9) DESC, thr) = 1
""")
def tree_best_split(spark, sf):
    """The best threshold of every feature."""
    rows = doc_shape(spark, sf)
    found = T.split_candidates(rows, [], [F.col(c) for c in SHAPE], "quality", F.lit(1.0), "gini", [0, 1])
    best = T.best_splits(found, ["feature"])
    names = F.array(*[F.lit(c) for c in SHAPE])
    return round_doubles(best.select(F.get(names, F.col("feature")).alias("feature"), "thr", "gain"))


def descend(rows: str, best: str) -> str:
    return (
        f"(SELECT x.* EXCLUDE (node), x.node * 2 + CASE WHEN {VALUE}[b.feature + 1] < b.thr THEN 0 ELSE 1 END AS node "
        f"FROM {rows} x JOIN {best} b ON x.node = b.node)"
    )


def level_sql(rows: str, best: str | None) -> str:
    cls = "CASE WHEN count(*) FILTER (quality = 1) > count(*) FILTER (quality = 0) THEN 1 ELSE 0 END"
    if best is None:
        return f"SELECT node::BIGINT AS node, NULL AS feature, NULL::DOUBLE AS thr, count(*) AS n, {cls} AS cls FROM {rows} GROUP BY node"
    return f"""SELECT x.node::BIGINT, {NAME}[any_value(b.feature) + 1], round(any_value(b.thr), 6), count(*), {cls}
FROM {rows} x LEFT JOIN {best} b ON x.node = b.node GROUP BY x.node"""


@query("tree_depth2", ROOT + scan_sql("r0", "a") + f", r1 AS {descend('r0', 'abest')}," + scan_sql("r1", "b")
       + f", r2 AS {descend('r1', 'bbest')} " + level_sql("r2", None) + " UNION ALL " + level_sql("r0", "abest")
       + " UNION ALL " + level_sql("r1", "bbest"))
def tree_depth2(spark, sf):
    return round_doubles(T.grow_tree(doc_shape(spark, sf), SHAPE, "quality", depth=2))


@query("samme_round", ROOT + scan_sql("r0", "a") + f""", r1 AS {descend('r0', 'abest')},
side AS (SELECT node, CASE WHEN count(*) FILTER (quality = 1) > count(*) FILTER (quality = 0) THEN 1 ELSE 0 END AS pred
         FROM r1 GROUP BY node),
p AS (SELECT quality, (quality <> pred)::INT AS miss FROM r1 JOIN side USING (node)),
e AS (SELECT avg(miss) AS err FROM p),
w AS (SELECT quality, CASE WHEN miss = 1 THEN exp(ln((1 - err) / err)) ELSE 1 END AS w FROM p, e)
SELECT round(ln((1 - err) / err), 6) AS alpha, round(err, 6) AS err, quality AS class,
       round(sum(w) / (SELECT sum(w) FROM w), 6) AS weight_sum FROM w, e GROUP BY quality, err
""")
def samme_round(spark, sf):
    """One boosting round with the best stump from equal weights."""
    docs = doc_shape(spark, sf)
    n = docs.count()
    rows = docs.withColumn("w", F.lit(1.0 / n))
    stump = T.grow_tree(rows, SHAPE, "quality", depth=1, weight="w")
    rows = T.tree_predict(rows, stump, 1)
    error = T.weighted_error(rows, "quality", "pred", "w")
    alpha = T.samme_alpha(error, 2)
    after = T.samme_reweight(rows, "quality", "pred", "w", alpha)
    return round_doubles(
        after.groupBy(F.col("quality").alias("class")).agg(F.sum("w").alias("weight_sum")).select(
            F.lit(alpha).alias("alpha"), F.lit(error).alias("err"), "class", "weight_sum"
        )
    )
