"""Stream queries: the driver tables read as streams until everything available is processed."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from lumenframe.operators.linear import least_squares
from lumenframe.plans.prep import round_doubles
from lumenframe.plans.records import ITEMS_PER_PAGE
from lumenframe.plans.registry import query
from lumenframe.sources.nested import thread_item
from lumenframe.sources.scratch import fresh_path
from lumenframe.sources.tables import table
from lumenframe.streaming import streams as X

CLOSED_SQL = "date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"


def events_stream(spark, sf):
    return X.parquet_stream(spark, sf, "events.parquet", table(spark, sf, "events").schema)


@query("stream_resample", f"""
SELECT date_trunc('day', ts) AS start, event_type, arg_min(value, (ts, event_id)) AS first, arg_max(value, (ts, event_id)) AS last,
       round(avg(value), 6) AS mean, count(value) AS cnt
FROM events WHERE {CLOSED_SQL} GROUP BY 1, 2
""", days=["start"])
def stream_resample(spark, sf):
    """Daily buckets per type; a bucket appears when the watermark has passed its end."""
    out = X.bucket_values(events_stream(spark, sf), "ts", ["event_type"], "event_id", "value", "1 day", "1 hour")
    return round_doubles(X.run_available(out, "stream"))


@query("stream_clean", """
SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS INT), -1) AS k, event_type <> 'error' AS valid FROM events
""")
def stream_clean(spark, sf):
    return X.run_available(X.clean_records(events_stream(spark, sf), "event_id", "props", "k", F.col("event_type") != "error"), "stream")


@query("stream_validity", f"""
SELECT date_trunc('day', ts) AS start, count(*) FILTER (event_type <> 'error') AS valid_cnt,
       count(*) FILTER (event_type = 'error') AS corrupted_cnt FROM events WHERE {CLOSED_SQL} GROUP BY 1
""", days=["start"])
def stream_validity(spark, sf):
    return X.run_available(X.validity_per_bucket(events_stream(spark, sf), "ts", F.col("event_type") != "error", "1 day", "1 hour"), "stream")


@query("stream_score", """
WITH e AS (SELECT event_id, value, json_extract_string(props, '$.k')::DOUBLE AS k FROM events)
SELECT event_id, round((SELECT regr_intercept(value, k) FROM e) + (SELECT regr_slope(value, k) FROM e) * k, 6) AS score FROM e
""")
def stream_score(spark, sf):
    """A line fitted on the table scores the stream."""
    k = F.get_json_object("props", "$.k").cast("double").alias("k")
    fit = least_squares(table(spark, sf, "events").select("value", k), ["k"], "value").collect()
    coef = {r["term"]: r["coef"] for r in fit}
    return round_doubles(X.run_available(X.score_linear(events_stream(spark, sf).select("event_id", k), coef, ["event_id"]), "stream"))


@query("stream_flatten", """
SELECT DISTINCT conv_id, role AS author, strftime(DATE '2024-01-01' + turn::INT, '%Y-%m-%d') AS date,
       strftime(DATE '2024-01-01' + turn::INT, '%Y-%m-%d') || 'T08:30:00Z' AS time, text AS comment FROM conversations
""")
def stream_flatten(spark, sf):
    """Every page arrives twice; each comment comes out once."""
    day = F.date_add(F.lit(datetime.date(2024, 1, 1)), F.col("turn").cast("int"))
    time = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T08:30:00Z"))
    items = table(spark, sf, "conversations").select(
        "conv_id", F.floor(F.col("turn") / ITEMS_PER_PAGE).alias("page"), thread_item(F.col("role"), time, F.col("text")).alias("item")
    )
    pages = items.groupBy("conv_id", "page").agg(F.collect_list("item").alias("items"))
    payload = F.to_json(F.struct("items", F.col("page").cast("string").alias("nextPageToken")))
    path = fresh_path(spark, "pages")
    sent = pages.select("conv_id", payload.alias("payload"), F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    sent.drop("copy").write.parquet(path)
    stream = spark.readStream.schema("conv_id long, payload string").parquet(path)
    identity = ["conv_id", "author", "time", "comment"]
    return X.run_available(X.flatten_pages(stream, "payload", identity, "400 days"), "stream")
