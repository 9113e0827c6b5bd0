"""Preparation, split and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.functions import scalars as S
from lumenframe.operators import prep as P
from lumenframe.operators import profile as A
from lumenframe.operators import splits
from lumenframe.operators.position import exact_quantiles
from lumenframe.operators.tuning import with_grid
from lumenframe.plans.registry import query
from lumenframe.sources.tables import table

PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
CORRELATED = (*PROFILED, "flag")
# Part types and the group each one belongs to; PROMO has none.
PART_GROUPS = {
    "ECONOMY": "plain",
    "STANDARD": "plain",
    "SMALL": "small",
    "MEDIUM": "large",
    "LARGE": "large",
}


@query("text_shape", "SELECT doc_id, length(text) AS n_len, round(octet_length(encode(text)) / 1024.0, 6) AS kb FROM documents")
def text_shape(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", S.text_length(F.col("text")).alias("n_len"), F.round(S.size_kb(F.col("text")), 6).alias("kb")
    )


@query("log_transform", """
SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 6) AS log_price,
       round(CASE WHEN l_discount > 0 THEN ln(l_discount) END, 6) AS log_discount FROM lineitem
""")
def log_transform(spark, sf):
    rows = table(spark, sf, "lineitem")
    return rows.select(
        "l_orderkey", "l_linenumber",
        F.round(S.safe_log(P.numeric_column(rows, "l_extendedprice")), 6).alias("log_price"),
        F.round(S.safe_log(P.numeric_column(rows, "l_discount")), 6).alias("log_discount"),
    )


@query("recode_category", """
SELECT grp, count(*) AS cnt FROM (SELECT CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'plain'
       WHEN p_type = 'SMALL' THEN 'small' WHEN p_type IN ('MEDIUM', 'LARGE') THEN 'large' END AS grp FROM part)
GROUP BY grp
""")
def recode_category(spark, sf):
    lookup = spark.createDataFrame(list(PART_GROUPS.items()), "from string, to string")
    return P.recode(table(spark, sf, "part"), "p_type", lookup, "grp").groupBy("grp").agg(F.count(F.lit(1)).alias("cnt"))


@query("label_encode", """
SELECT event_type, dense_rank() OVER (ORDER BY event_type) - 1 AS code, cnt
FROM (SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type)
""")
def label_encode(spark, sf):
    coded = P.label_encode(table(spark, sf, "events").select("event_type"), "event_type")
    return coded.groupBy("event_type", "code").agg(F.count(F.lit(1)).alias("cnt"))


@query("first_seen_encode", """
SELECT user_id, row_number() OVER (ORDER BY f) AS ord
FROM (SELECT user_id, min((ts, event_id)) AS f FROM events GROUP BY user_id)
""")
def first_seen_encode(spark, sf):
    return P.first_seen_codes(table(spark, sf, "events"), "user_id", ["ts", "event_id"])


@query("one_hot", "SELECT event_id, " + ", ".join(
    f"CASE WHEN event_type = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS event_type_{v}"
    for v in ("click", "error", "purchase", "signup", "view")
) + " FROM events")
def one_hot(spark, sf):
    return P.one_hot(P.select_columns(table(spark, sf, "events"), "event_id", "event_type"), "event_type")


@query("prep_features", """
SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS label, o_totalprice,
""" + ", ".join(
    f"CASE WHEN o_orderstatus = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS o_orderstatus_{v}" for v in "FOP"
) + " FROM orders")
def prep_features(spark, sf):
    rows = P.drop_columns(table(spark, sf, "orders"), "o_custkey", "o_orderdate")
    return P.features_and_target(rows, "o_orderpriority", keep=["o_orderkey"])


@query("holdout_ordered", """
SELECT event_id, CASE WHEN pos <= n - ceil(n * 0.2) THEN 'train' ELSE 'test' END AS part
FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS pos, count(*) OVER () AS n FROM events)
""")
def holdout_ordered(spark, sf):
    return splits.holdout_ordered(table(spark, sf, "events").select("event_id"), "event_id", 0.2)


@query("holdout_hashed", """
SELECT event_id, CASE WHEN ('0x' || substr(md5(event_id::VARCHAR || '-42'), 1, 8))::BIGINT % 100 < 75
                 THEN 'train' ELSE 'test' END AS part FROM events
""")
def holdout_hashed(spark, sf):
    return splits.holdout_hashed(table(spark, sf, "events").select("event_id"), "event_id", 75)


@query("holdout_chrono", """
SELECT o_orderpriority, part, count(*) AS cnt, min(d)::DATE AS min_date, max(d)::DATE AS max_date,
       sum(o_orderkey)::BIGINT AS key_sum
FROM (SELECT o_orderpriority, o_orderkey, o_orderdate AS d,
             CASE WHEN row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey)
                  <= ceil(count(*) OVER (PARTITION BY o_orderpriority) * 0.8) THEN 'train' ELSE 'test' END AS part
      FROM orders)
GROUP BY o_orderpriority, part
""", days=["min_date", "max_date"])
def holdout_chrono(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderpriority", "o_orderdate", "o_orderkey")
    parts = splits.holdout_chrono(rows, ["o_orderpriority"], "o_orderdate", "o_orderkey")
    day = F.col("o_orderdate").cast("date")
    return parts.groupBy("o_orderpriority", "part").agg(
        F.count(F.lit(1)).alias("cnt"), F.min(day).alias("min_date"), F.max(day).alias("max_date"),
        F.sum("o_orderkey").alias("key_sum"),
    )


@query("bootstrap_counts", """
WITH h AS (SELECT event_id, ('0x' || substr(md5(event_id::VARCHAR || '-42-bootstrap'), 1, 12))::BIGINT / pow(16, 12) AS u
           FROM events),
term AS (SELECT k, exp(-1) / list_product([x FOR x IN generate_series(1, greatest(k, 1))]) AS m
         FROM generate_series(0, 11) AS g(k)),
cdf AS (SELECT k, sum(m) OVER (ORDER BY k) AS c FROM term)
SELECT event_id, (SELECT count(*) FROM cdf WHERE c <= u)::INT AS mult FROM h
""")
def bootstrap_counts(spark, sf):
    return splits.bootstrap_counts(table(spark, sf, "events").select("event_id"), "event_id")


@query("oversample", """
SELECT event_type, (count(*) * CASE WHEN event_type = 'error' THEN 2 ELSE 1 END)::BIGINT AS cnt
FROM events GROUP BY event_type
""")
def oversample(spark, sf):
    rows = splits.oversample(table(spark, sf, "events").select("event_type"), F.col("event_type") == "error")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))


def round_doubles(df, digits: int = 6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("column_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS col, 'double' AS dtype, count({c}) AS cnt, round(avg({c}), 6) AS mean, round(stddev({c}), 6) AS std,
    round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS q2,
    round(quantile_cont({c}, 0.75), 6) AS q3, round(max({c}), 6) AS max, round(max({c}) - min({c}), 6) AS rng FROM lineitem"""
    for c in PROFILED
))
def column_profile(spark, sf):
    return round_doubles(A.column_profile(table(spark, sf, "lineitem"), PROFILED))


DISTINCT = ("l_returnflag", "l_linestatus", "l_tax")


@query("distinct_values", " UNION ALL ".join(
    f"SELECT '{c}' AS col, {c}::VARCHAR AS value, count(*) AS cnt FROM lineitem GROUP BY {c}" for c in DISTINCT
))
def distinct_values(spark, sf):
    return A.distinct_values(table(spark, sf, "lineitem"), DISTINCT)


@query("distinct_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS col, count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in (*DISTINCT, "l_orderkey")
))
def distinct_counts(spark, sf):
    return A.distinct_counts(table(spark, sf, "lineitem"), (*DISTINCT, "l_orderkey"))


@query("correlation_matrix", """WITH v AS (SELECT *, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS flag
FROM lineitem) """ + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM v" for a in CORRELATED for b in CORRELATED
))
def correlation_matrix(spark, sf):
    rows = P.label_encode(table(spark, sf, "lineitem").select(*PROFILED, "l_returnflag"), "l_returnflag", "flag")
    return round_doubles(A.correlation_matrix(rows, CORRELATED))


@query("histogram", """
WITH m AS (SELECT min(value) AS lo, (max(value) - min(value)) / 25 AS w FROM events),
c AS (SELECT least(floor((value - lo) / w), 24) AS bin, count(*) AS cnt FROM events, m GROUP BY 1)
SELECT g.bin::INT AS bin, round(m.lo + g.bin * m.w, 6) AS lo, coalesce(cnt, 0) AS cnt
FROM generate_series(0, 24) AS g(bin) CROSS JOIN m LEFT JOIN c ON c.bin = g.bin
""")
def histogram(spark, sf):
    return round_doubles(A.histogram(table(spark, sf, "events"), "value", 25))


@query("box_summary", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)
SELECT event_type, round(q1, 6) AS q1, round(q2, 6) AS q2, round(q3, 6) AS q3,
       round(min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)), 6) AS lo,
       round(max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)), 6) AS hi,
       count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_out
FROM events JOIN q USING (event_type) GROUP BY event_type, q1, q2, q3
""")
def box_summary(spark, sf):
    return round_doubles(A.box_summary(table(spark, sf, "events").select("event_type", "value"), ["event_type"], "value"))


SHAPE = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}


@query("grouped_quantiles", "SELECT user_id, " + ", ".join(
    f"round(quantile_cont(value, {p}), 6) AS {n}" for n, p in SHAPE.items()
) + " FROM events GROUP BY user_id")
def grouped_quantiles(spark, sf):
    return round_doubles(exact_quantiles(table(spark, sf, "events"), ["user_id"], "value", SHAPE))


@query("zscore", """
SELECT event_id, round((value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0), 6) AS z
FROM events WINDOW w AS (PARTITION BY user_id)
""")
def zscore(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "value")
    return round_doubles(A.zscore(rows, ["user_id"], "value").select("event_id", "z"))


@query("param_grid", """
SELECT o_orderpriority, p::INT AS p, q::INT AS q, sp::INT AS sp, sq::INT AS sq
FROM (SELECT DISTINCT o_orderpriority FROM orders), generate_series(1, 4) AS a(p), generate_series(1, 4) AS b(q),
     generate_series(1, 2) AS c(sp), generate_series(1, 2) AS d(sq)
""")
def param_grid(spark, sf):
    """Every series with every parameter set: the input of an order search."""
    series = table(spark, sf, "orders").select("o_orderpriority").distinct()
    return with_grid(series, {"p": range(1, 5), "q": range(1, 5), "sp": range(1, 3), "sq": range(1, 3)})
