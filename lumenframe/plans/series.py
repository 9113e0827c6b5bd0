"""Series queries: weekly sums of the order price in millions, one series per priority."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from lumenframe.operators import series as S
from lumenframe.operators import series_fit as SF
from lumenframe.operators.metrics import aic
from lumenframe.plans.linear import det3
from lumenframe.plans.prep import round_doubles
from lumenframe.plans.registry import query
from lumenframe.sources.scratch import materialize
from lumenframe.sources.tables import table

KEY = ["o_orderpriority"]
SEASON = 13
PERIOD = 14
STEPS = 12

WK_SQL = """wk AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY week) - 1 AS pos FROM (
    SELECT o_orderpriority, o + (floor((o_orderdate::DATE - o) / 7) * 7)::INT AS week,
           sum(o_totalprice::DECIMAL(18, 2))::DOUBLE / 1e6 AS y
    FROM orders, (SELECT min(o_orderdate)::DATE AS o FROM orders) GROUP BY 1, 2))"""
WIN = "WINDOW w AS (PARTITION BY o_orderpriority ORDER BY week)"


def weekly(spark, sf):
    price = F.col("o_totalprice").cast("decimal(18,2)")
    sums = S.bucket_sum(table(spark, sf, "orders"), KEY, "o_orderdate", price, 7)
    return materialize(sums.withColumn("y", F.col("y").cast("double") / 1e6), "weekly")


def resample_sql(days: int) -> str:
    return f"""SELECT {days} AS days, k.o_orderpriority, b::DATE AS bin_start, f AS first
FROM (SELECT DISTINCT o_orderpriority FROM orders) k
CROSS JOIN (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL {days} DAY)) AS b FROM orders)
LEFT JOIN (SELECT o_orderpriority, time_bucket(INTERVAL {days} DAY, o_orderdate::DATE, (SELECT min(o_orderdate)::DATE FROM orders)) AS b,
                  arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS f FROM orders GROUP BY 1, 2) v
USING (o_orderpriority, b)"""


@query("resample_first", resample_sql(7) + " UNION ALL " + resample_sql(1), days=["bin_start"])
def resample_first(spark, sf):
    """Weekly and daily bins; by day there are gaps."""
    orders = table(spark, sf, "orders").select(*KEY, "o_orderdate", "o_orderkey", "o_totalprice")
    weeks, days = (
        S.resample_first(orders, KEY, "o_orderdate", "o_orderkey", "o_totalprice", n).select(F.lit(n).alias("days"), "*")
        for n in (7, 1)
    )
    return weeks.unionByName(days)


@query("lag_diff", f"""WITH {WK_SQL}
SELECT o_orderpriority, week, round(y - lag(y) OVER w, 6) AS diff, round(y - lag(y, {SEASON}) OVER w, 6) AS diff_season,
       round(ln(y) - lag(ln(y)) OVER w, 6) AS log_diff, round(ln(y) - lag(ln(y), {SEASON}) OVER w, 6) AS log_diff_season,
       round(lag(y, 2) OVER w, 6) AS shifted FROM wk {WIN}
""", days=["week"])
def lag_diff(spark, sf):
    rows = weekly(spark, sf).withColumn("l", F.ln(F.when(F.col("y") > 0, F.col("y"))))
    for src, n, out in (("y", 1, "diff"), ("y", SEASON, "diff_season"), ("l", 1, "log_diff"), ("l", SEASON, "log_diff_season")):
        rows = S.difference(rows, KEY, "week", src, n, out)
    return round_doubles(S.shift(rows, KEY, "week", "y", 2, "shifted").drop("y", "l"))


@query("seasonal_diff", f"""WITH {WK_SQL}
SELECT o_orderpriority, week, round(y - lag(y) OVER w - lag(y, {SEASON}) OVER w + lag(y, {SEASON + 1}) OVER w, 8) AS y
FROM wk {WIN} QUALIFY row_number() OVER w > {SEASON + 1}
""", days=["week"])
def seasonal_diff(spark, sf):
    return round_doubles(S.seasonal_diff(weekly(spark, sf), KEY, "week", "y", 1, 1, SEASON), 8)


@query("lag_matrix", f"""WITH {WK_SQL}
SELECT o_orderpriority, week, round(y, 6) AS y, round(lag(y, 1, 0) OVER w, 6) AS l1, round(lag(y, 2, 0) OVER w, 6) AS l2,
       round(lag(y, 13, 0) OVER w, 6) AS s13, round(lag(y, 14, 0) OVER w, 6) AS m13_1, round(lag(y, 15, 0) OVER w, 6) AS m13_2
FROM wk {WIN}
""", days=["week"])
def lag_matrix(spark, sf):
    return round_doubles(S.lag_matrix(weekly(spark, sf), KEY, "week", "y", S.lag_columns(2, 1, SEASON)))


@query("inverse_diff", f"WITH {WK_SQL} SELECT o_orderpriority, week, round(y, 8) AS level1, round(y, 8) AS level13 FROM wk", days=["week"])
def inverse_diff(spark, sf):
    """Levels rebuilt from log differences: they must be the levels the differences came from."""
    rows = weekly(spark, sf).withColumn("l", F.ln("y"))
    for n in (1, SEASON):
        rows = S.difference(rows, KEY, "week", "l", n, f"d{n}")
        rows = S.inverse_diff(rows, KEY, "week", f"d{n}", "l", n, f"level{n}", log=True)
    return round_doubles(rows.select(*KEY, "week", "level1", "level13"), 8)


@query("integrate_predictions", f"""WITH {WK_SQL}
SELECT o_orderpriority, week, round(lag(y) OVER w + lag(y, {SEASON}) OVER w - lag(y, {SEASON + 1}) OVER w, 8) AS level FROM wk {WIN}
""", days=["week"])
def integrate_predictions(spark, sf):
    rows = weekly(spark, sf).withColumn("p", F.lit(0.0))
    out = S.integrate_predictions(rows, KEY, "week", "y", "p", "level", 1, 1, SEASON)
    return round_doubles(out.select(*KEY, "week", "level"), 8)


@query("seasonal_decompose", f"""WITH {WK_SQL},
t AS (SELECT o_orderpriority, week, pos % {PERIOD} AS phase, y,
             CASE WHEN lag(y, 7) OVER w IS NOT NULL AND lead(y, 7) OVER w IS NOT NULL
                  THEN (sum(y) OVER (PARTITION BY o_orderpriority ORDER BY week ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)
                        + 0.5 * lag(y, 7) OVER w + 0.5 * lead(y, 7) OVER w) / {PERIOD} END AS trend FROM wk {WIN}),
m AS (SELECT o_orderpriority, phase, avg(y - trend) AS m FROM t GROUP BY ALL),
s AS (SELECT o_orderpriority, phase, m - avg(m) OVER (PARTITION BY o_orderpriority) AS seasonal FROM m)
SELECT o_orderpriority, week, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, round(y - trend - seasonal, 6) AS resid
FROM t JOIN s USING (o_orderpriority, phase)
""", days=["week"])
def seasonal_decompose(spark, sf):
    return round_doubles(S.decompose(weekly(spark, sf), KEY, "week", "y", PERIOD).drop("y"))


@query("autocorrelation", f"""WITH {WK_SQL},
c AS (SELECT o_orderpriority, pos, y - avg(y) OVER (PARTITION BY o_orderpriority) AS c FROM wk)
SELECT a.o_orderpriority, k::INT AS lag, round(sum(a.c * b.c) / any_value(v), 6) AS r
FROM generate_series(0, 20) AS g(k) JOIN c a ON true JOIN c b ON a.o_orderpriority = b.o_orderpriority AND b.pos = a.pos + k
JOIN (SELECT o_orderpriority, sum(c * c) AS v FROM c GROUP BY 1) t ON t.o_orderpriority = a.o_orderpriority
GROUP BY 1, 2
""")
def autocorrelation(spark, sf):
    return round_doubles(S.autocorrelation(weekly(spark, sf), KEY, "week", "y", 20))


@query("combine_series", f"""WITH {WK_SQL}
SELECT o_orderpriority, week, round(CASE WHEN week < DATE '1999-06-01' THEN y ELSE y + 1000 END, 6) AS y FROM wk
""", days=["week"])
def combine_series(spark, sf):
    """Two overlapping halves, the later one raised: where both have a week the first wins."""
    rows = weekly(spark, sf)
    early = rows.filter(F.col("week") < datetime.date(1999, 6, 1))
    late = rows.filter(F.col("week") >= datetime.date(1997, 1, 1)).withColumn("y", F.col("y") + 1000)
    return round_doubles(S.combine_first(early, late, [*KEY, "week"], "y"))


@query("adf_lag0", f"""WITH {WK_SQL},
d AS (SELECT o_orderpriority, y - lag(y) OVER w AS dy, lag(y) OVER w AS x FROM wk {WIN}),
f AS (SELECT o_orderpriority, regr_slope(dy, x) AS beta, regr_sxx(dy, x) AS sxx, regr_syy(dy, x) AS syy, count(x) AS n
      FROM d GROUP BY 1)
SELECT o_orderpriority, round(beta, 6) AS beta, round(beta / sqrt((syy - beta * beta * sxx) / (n - 2) / sxx), 6) AS t_stat FROM f
""")
def adf_lag0(spark, sf):
    return round_doubles(SF.unit_root_lag0(weekly(spark, sf), KEY, "week", "y"))


@query("aic_select", f"""WITH {WK_SQL},
p AS (SELECT o_orderpriority, y, lag(y) OVER w AS x FROM wk {WIN} QUALIFY x IS NOT NULL),
f AS (SELECT o_orderpriority, avg(y) AS m, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM p GROUP BY 1),
r AS (SELECT o_orderpriority, count(*) * ln(sum(pow(y - m, 2)) / count(*)) + 2 AS ar0,
             count(*) * ln(sum(pow(y - a - b * x, 2)) / count(*)) + 4 AS ar1 FROM p JOIN f USING (o_orderpriority) GROUP BY 1)
SELECT o_orderpriority, 'ar0' AS model, round(ar0, 6) AS aic, ar0 < ar1 AS chosen FROM r
UNION ALL SELECT o_orderpriority, 'ar1', round(ar1, 6), ar1 <= ar0 FROM r
""")
def aic_select(spark, sf):
    pairs = weekly(spark, sf).withColumn("x", S.lagged(F.col("y"), 1, KEY, "week")).filter("x IS NOT NULL")
    fits = pairs.groupBy(*KEY).agg(
        F.avg("y").alias("m"), F.regr_slope("y", "x").alias("b"), F.regr_intercept("y", "x").alias("a")
    )
    models = F.array(
        F.struct(F.lit("ar0").alias("model"), F.lit(1).alias("k"), (F.col("y") - F.col("m")).alias("e")),
        F.struct(F.lit("ar1").alias("model"), F.lit(2).alias("k"), (F.col("y") - F.col("a") - F.col("b") * F.col("x")).alias("e")),
    )
    long = pairs.join(fits, KEY).select(*KEY, F.inline(models))
    scores = long.groupBy(*KEY, "model").agg(aic(F.col("e"), F.first("k")).alias("aic"))
    best = scores.groupBy(*KEY).agg(F.min_by("model", F.struct("aic", "model")).alias("best"))
    return round_doubles(scores.join(best, KEY).select(*KEY, "model", "aic", (F.col("model") == F.col("best")).alias("chosen")))


@query("adf_select")
def adf_select(spark, sf):
    return round_doubles(SF.stationarity(weekly(spark, sf), KEY, "week", "y", SEASON))


@query("hannan_rissanen")
def hannan_rissanen(spark, sf):
    return round_doubles(SF.hannan_rissanen(weekly(spark, sf), KEY, "week", "y", 2, 1))


@query("seasonal_arma_fit")
def seasonal_arma_fit(spark, sf):
    """All coefficients of a seasonal fit: AR, MA and both seasonal parts."""
    return round_doubles(SF.hannan_rissanen(weekly(spark, sf), KEY, "week", "y", 1, 1, (1, 1, SEASON)))


LAGS = S.lag_columns(1, 1, SEASON)
AR_ALPHA = 0.5


def ar_fit_sql() -> str:
    t = list(LAGS)
    m = [[f"({min(a, b)}_{max(a, b)}{f' + {AR_ALPHA}' if a == b else ''})" for b in t] for a in t]
    rhs = [f"r_{a}" for a in t]
    coefs = []
    for j, name in enumerate(t):
        col = [[rhs[i] if k == j else m[i][k] for k in range(3)] for i in range(3)]
        coefs.append(f"{det3(col)} / {det3(m)} AS {name}")
    sums = [f"sum({a} * {b}) AS {a}_{b}" for a in t for b in t if a <= b] + [f"sum({a} * c) AS r_{a}" for a in t]
    lags = ", ".join(f"lag(c, {n}, 0) OVER w AS {a}" for a, n in LAGS.items())
    return f"""WITH {WK_SQL},
x AS (SELECT o_orderpriority, week, y - avg(y) OVER (PARTITION BY o_orderpriority) AS c FROM wk),
lm AS (SELECT o_orderpriority, week, c, {lags} FROM x {WIN}),
f AS (SELECT o_orderpriority, {', '.join(coefs)} FROM (SELECT o_orderpriority, {', '.join(sums)} FROM lm GROUP BY 1))"""


def centred(spark, sf):
    rows = weekly(spark, sf)
    mean = rows.groupBy(*KEY).agg(F.avg("y").alias("m"))
    return materialize(rows.join(mean, KEY).select(*KEY, "week", (F.col("y") - F.col("m")).alias("c")), "centred")


@query("seasonal_ar_fit", ar_fit_sql() + " SELECT o_orderpriority, " + ", ".join(f"round({c}, 6) AS {c}" for c in LAGS) + " FROM f")
def seasonal_ar_fit(spark, sf):
    return round_doubles(SF.lag_ridge(centred(spark, sf), KEY, "week", "c", LAGS, AR_ALPHA))


PRED_SQL = " + ".join(f"lm.{c} * f.{c}" for c in LAGS)


@query("seasonal_ar_predict", ar_fit_sql() + f"""
SELECT lm.o_orderpriority, week, round({PRED_SQL}, 6) + 0.0 AS pred, round(c - ({PRED_SQL}), 6) AS resid FROM lm JOIN f USING (o_orderpriority)
""", days=["week"])
def seasonal_ar_predict(spark, sf):
    rows = centred(spark, sf)
    coef = SF.lag_ridge(rows, KEY, "week", "c", LAGS, AR_ALPHA)
    return round_doubles(SF.in_sample(rows, KEY, "week", "c", LAGS, coef))


@query("order_search")
def order_search(spark, sf):
    grid = [(p, q, sp, sq) for p in range(1, 5) for q in range(1, 5) for sp in range(1, 3) for sq in range(1, 3)]
    return round_doubles(SF.order_search(weekly(spark, sf), KEY, "week", "y", grid, 1, 1, SEASON))


@query("forecast_ar1", f"""WITH {WK_SQL},
c AS (SELECT o_orderpriority, week, y, y - avg(y) OVER (PARTITION BY o_orderpriority) AS c FROM wk),
l AS (SELECT *, lag(c) OVER w AS p FROM c {WIN}),
f AS (SELECT o_orderpriority, avg(y) AS m, arg_max(c, week) AS last, sum(c * p) / sum(p * p) AS phi FROM l GROUP BY 1)
SELECT o_orderpriority, h::INT AS h, round(m + pow(phi, h) * last, 6) AS y_hat FROM f, generate_series(1, {STEPS}) AS g(h)
""")
def forecast_ar1(spark, sf):
    return round_doubles(S.ar1_forecast(weekly(spark, sf), KEY, "week", "y", STEPS))


@query("forecast_h")
def forecast_h(spark, sf):
    return round_doubles(SF.forecast(weekly(spark, sf), KEY, "week", "y", (1, 1, 1), (1, 1, 1, SEASON), STEPS))
