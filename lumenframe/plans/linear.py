"""Linear models on ``lineitem`` (price in thousands) and on the document shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions.scalars import threshold_class
from lumenframe.operators import linear as L
from lumenframe.operators.splits import holdout_hashed
from lumenframe.plans.features import DOCZ_SQL, SHAPE, doc_shape_scaled
from lumenframe.plans.prep import round_doubles
from lumenframe.plans.registry import query
from lumenframe.sources.tables import table

ALPHA = 10.0
RATE, L1, L2, STEPS = 0.5, 0.001, 0.01, 20


def priced(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"), (F.col("l_extendedprice") / 1000).alias("y")
    )


PRICED_SQL = "li AS (SELECT l_orderkey, l_quantity AS q, l_discount AS d, l_extendedprice / 1000 AS y FROM lineitem)"


@query("linreg_fit", f"""WITH {PRICED_SQL},
f AS (SELECT regr_slope(y, q) AS b, regr_intercept(y, q) AS a, regr_r2(y, q) AS r2, regr_sxx(y, q) AS sxx,
             regr_syy(y, q) AS syy, count(*) AS n, avg(q) AS mq FROM li),
g AS (SELECT *, syy * (1 - r2) / (n - 2) AS s2 FROM f)
SELECT 'intercept' AS term, round(a, 6) AS coef, round(sqrt(s2 * (1 / n + mq * mq / sxx)), 6) AS se,
       round(a / sqrt(s2 * (1 / n + mq * mq / sxx)), 4) AS t, round(r2, 6) AS r2 FROM g
UNION ALL SELECT 'q', round(b, 6), round(sqrt(s2 / sxx), 6), round(b / sqrt(s2 / sxx), 4), round(r2, 6) FROM g
""")
def linreg_fit(spark, sf):
    fit = L.least_squares(priced(spark, sf), ["q"], "y")
    return fit.select("term", *[F.round(c, 4 if c == "t" else 6).alias(c) for c in ("coef", "se", "t", "r2")])


@query("linreg_residuals", f"""WITH {PRICED_SQL},
p AS (SELECT *, CASE WHEN ('0x' || substr(md5(l_orderkey::VARCHAR || '-42'), 1, 8))::BIGINT % 100 < 75 THEN 'train' ELSE 'test' END AS part
      FROM li),
f AS (SELECT regr_slope(y, q) AS b, regr_intercept(y, q) AS a FROM p WHERE part = 'train')
SELECT part, count(*) AS n, round(avg(abs(y - a - b * q)), 6) AS mae, round(avg(pow(y - a - b * q, 2)), 4) AS mse
FROM p, f GROUP BY part
""")
def linreg_residuals(spark, sf):
    """Fit on the train part; errors of both parts, rows matched by their own line."""
    rows = holdout_hashed(priced(spark, sf), "l_orderkey", 75)
    fit = L.least_squares(rows.filter("part = 'train'"), ["q"], "y").collect()
    pred = L.linear_score({r["term"]: r["coef"] for r in fit})
    gap = F.col("y") - pred
    return rows.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.abs(gap)), 6).alias("mae"), F.round(F.avg(gap * gap), 4).alias("mse")
    )


@query("ols_summary", f"""WITH {PRICED_SQL},
s AS (SELECT sum(q * q) AS a, sum(q * d) AS b, sum(d * d) AS c, sum(q * y) AS u, sum(d * y) AS v, sum(y * y) AS yy, count(*) AS n
      FROM li),
f AS (SELECT *, a * c - b * b AS det, (c * u - b * v) / (a * c - b * b) AS bq, (a * v - b * u) / (a * c - b * b) AS bd FROM s),
g AS (SELECT *, yy - bq * u - bd * v AS sse FROM f)
SELECT 'q' AS term, round(bq, 6) AS coef, round(sqrt(c / det * sse / (n - 2)), 6) AS se,
       round(bq / sqrt(c / det * sse / (n - 2)), 4) AS t, round(1 - sse / yy, 6) AS r2 FROM g
UNION ALL SELECT 'd', round(bd, 6), round(sqrt(a / det * sse / (n - 2)), 6), round(bd / sqrt(a / det * sse / (n - 2)), 4),
       round(1 - sse / yy, 6) FROM g
""")
def ols_summary(spark, sf):
    fit = L.least_squares(priced(spark, sf), ["q", "d"], "y", intercept=False)
    return fit.select("term", *[F.round(c, 4 if c == "t" else 6).alias(c) for c in ("coef", "se", "t", "r2")])


def det3(m: list[list[str]]) -> str:
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"({a}*({e}*{i}-{f}*{h}) - {b}*({d}*{i}-{f}*{g}) + {c}*({d}*{h}-{e}*{g}))"


def ridge_sql() -> str:
    m = [["(n+al)", "sq", "sd"], ["sq", "(qq+al)", "qd"], ["sd", "qd", "(dd+al)"]]
    rhs = ["sy", "qy", "dy"]
    terms = []
    for j, name in enumerate(("intercept", "q", "d")):
        col = [[rhs[i] if k == j else m[i][k] for k in range(3)] for i in range(3)]
        terms.append(f"SELECT '{name}' AS term, round({det3(col)} / {det3(m)}, 6) AS coef FROM s")
    return f"""WITH {PRICED_SQL},
s AS (SELECT count(*)::DOUBLE AS n, {ALPHA} AS al, sum(q) AS sq, sum(d) AS sd, sum(y) AS sy, sum(q * q) AS qq, sum(q * d) AS qd,
             sum(d * d) AS dd, sum(q * y) AS qy, sum(d * y) AS dy FROM (SELECT q::DOUBLE AS q, d, y FROM li))
""" + " UNION ALL ".join(terms)


@query("ridge_fit", ridge_sql().replace(f"{ALPHA} AS al", f"{ALPHA}::DOUBLE AS al"))
def ridge_fit(spark, sf):
    rows = priced(spark, sf)
    return round_doubles(L.coefficient_table(rows, L.ridge(rows, ["q", "d"], "y", ALPHA)))


@query("ridge_classifier", f"""WITH {DOCZ_SQL},
z AS (SELECT doc_id, n_chars AS u, mean_len AS v, 2 * quality - 1 AS y FROM docz),
s AS (SELECT sum(u * u) + 1 AS a, sum(u * v) AS b, sum(v * v) + 1 AS c, sum(u * y) AS p, sum(v * y) AS q, avg(y) AS m FROM z)
SELECT doc_id, CASE WHEN m + (c * p - b * q) / (a * c - b * b) * u + (a * q - b * p) / (a * c - b * b) * v > 0
               THEN 1 ELSE 0 END AS pred, round(m + (c * p - b * q) / (a * c - b * b) * u + (a * q - b * p) / (a * c - b * b) * v, 6) AS score
FROM z, s
""")
def ridge_classifier(spark, sf):
    """Ridge on a -1/+1 target with a free intercept; the class is the sign."""
    rows = doc_shape_scaled(spark, sf).withColumn("y", F.col("quality") * 2 - 1)
    score = L.linear_score(L.ridge(rows, ["n_chars", "mean_len"], "y", 1.0, penalize_intercept=False))
    return rows.select("doc_id", threshold_class(score).alias("pred"), F.round(score, 6).alias("score"))


@query("gd_one_step", f"WITH {DOCZ_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS term, round(-{RATE} * avg((0.5 - quality) * {c}), 6) AS coef FROM docz" for c in SHAPE
))
def gd_one_step(spark, sf):
    rows = doc_shape_scaled(spark, sf)
    weights, _ = L.gradient_descent(rows, SHAPE, "quality", "cross_entropy", RATE, 1)
    return round_doubles(L.coefficient_table(rows, weights))


def curve_sql() -> str:
    parts = ["w0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS a_{c}" for c in SHAPE) + ", 0.0::DOUBLE AS loss)"]
    z = " + ".join(f"a_{c} * {c}" for c in SHAPE)
    for k in range(STEPS):
        cols = ", ".join(
            f"any_value(a_{c}) - {RATE} * (avg((1 / (1 + exp(-({z}))) - quality) * {c}) + {L2} * any_value(a_{c}) "
            f"+ {L1} * sign(any_value(a_{c}))) AS a_{c}"
            for c in SHAPE
        )
        p = f"(1 / (1 + exp(-({z}))))"
        parts.append(
            f"w{k + 1} AS MATERIALIZED (SELECT {cols}, -avg(quality * ln({p}) + (1 - quality) * ln(1 - {p})) AS loss FROM docz, w{k})"
        )
    rows = " UNION ALL ".join(f"SELECT {k} AS step, round(loss, 6) AS loss FROM w{k}" for k in range(1, STEPS + 1))
    return f"WITH {DOCZ_SQL.replace('docz AS (', 'docz AS MATERIALIZED (')}, {', '.join(parts)} {rows}"


def accuracy_curve_sql() -> str:
    parts = ["w0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS a_{c}" for c in SHAPE) + ", 0.0::DOUBLE AS hits)"]
    z = " + ".join(f"a_{c} * {c}" for c in SHAPE)
    for k in range(STEPS):
        cols = ", ".join(
            f"any_value(a_{c}) - {RATE} * (avg((1 / (1 + exp(-({z}))) - quality) * {c}) + {L2} * any_value(a_{c}) "
            f"+ {L1} * sign(any_value(a_{c}))) AS a_{c}"
            for c in SHAPE
        )
        hit = f"CASE WHEN (round({z}, 9) > 0) = (quality = 1) THEN 100.0 ELSE 0.0 END"
        parts.append(f"w{k + 1} AS MATERIALIZED (SELECT {cols}, avg({hit}) AS hits FROM docz, w{k})")
    rows = " UNION ALL ".join(f"SELECT {k} AS step, round(hits, 6) AS accuracy FROM w{k}" for k in range(1, STEPS + 1))
    return f"WITH {DOCZ_SQL.replace('docz AS (', 'docz AS MATERIALIZED (')}, {', '.join(parts)} {rows}"


@query("gd_accuracy_curve", accuracy_curve_sql())
def gd_accuracy_curve(spark, sf):
    """A learning curve of the caller: the accuracy before each step."""
    rows = doc_shape_scaled(spark, sf)

    def hits(y, z):
        return F.avg(F.when((F.round(z, 9) > 0) == (y == 1), 100.0).otherwise(0.0))

    _, curve = L.gradient_descent(rows, SHAPE, "quality", "cross_entropy", RATE, STEPS, L1, L2, curve_of=hits)
    steps = spark.createDataFrame(list(enumerate(curve, 1)), "step int, accuracy double")
    return round_doubles(steps)


@query("gd_curve", curve_sql())
def gd_curve(spark, sf):
    """The learning curve: the loss before each step."""
    rows = doc_shape_scaled(spark, sf)
    _, curve = L.gradient_descent(rows, SHAPE, "quality", "cross_entropy", RATE, STEPS, L1, L2)
    steps = spark.createDataFrame(list(enumerate(curve, 1)), "step int, loss double")
    return round_doubles(steps)
