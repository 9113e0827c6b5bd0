"""Record and source queries."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from lumenframe.functions import scalars as S
from lumenframe.operators import records as R
from lumenframe.operators.prep import record_defaults
from lumenframe.operators.splits import capped, date_window
from lumenframe.plans.registry import query
from lumenframe.sources.delimited import read_delimited, write_sheet
from lumenframe.sources.nested import flatten_threads, thread_item
from lumenframe.sources.pages import page_fields
from lumenframe.sources.scratch import fresh_path
from lumenframe.sources.tables import table

ITEMS_PER_PAGE = 20


@query("csv_roundtrip", """
SELECT c_custkey, c_name, n_name, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0
""")
def csv_roundtrip(spark, sf):
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    path = fresh_path(spark, "sheet")
    titles = {"c_custkey": "customer id", "c_name": "name", "n_name": "nation", "c_acctbal": "balance"}
    write_sheet(rows, path, titles, valid=F.col("c_acctbal") > 0, separator=";")
    schema = "c_custkey long, c_name string, n_name string, c_acctbal double"
    return read_delimited(spark, path, schema, separator=";")


@query("split_rows", "SELECT p_partkey, p_name AS c0, p_brand AS c1, p_type AS c2 FROM part")
def split_rows(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.concat_ws(";", "p_name", "p_brand", "p_type").alias("row"))
    return rows.select("p_partkey", *[c.alias(f"c{i}") for i, c in enumerate(S.split_row(F.col("row"), 3))])


@query("flatten_threads", """
SELECT conv_id, role AS author, strftime(DATE '2024-01-01' + turn::INT, '%Y-%m-%d') AS date,
       strftime(DATE '2024-01-01' + turn::INT, '%Y-%m-%d') || 'T08:30:00Z' AS time, text AS comment
FROM conversations
""")
def flatten_threads_query(spark, sf):
    """Turns packed as JSON pages of at most ITEMS_PER_PAGE consecutive turns, then flattened."""
    turns = table(spark, sf, "conversations")
    day = F.date_add(F.lit(datetime.date(2024, 1, 1)), F.col("turn").cast("int"))
    time = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T08:30:00Z"))
    items = turns.select(
        "conv_id",
        F.floor(F.col("turn") / ITEMS_PER_PAGE).alias("page"),
        thread_item(F.col("role"), time, F.col("text")).alias("item"),
    )
    pages = items.groupBy("conv_id", "page").agg(F.collect_list("item").alias("items"))
    payload = F.to_json(F.struct("items", F.col("page").cast("string").alias("nextPageToken")))
    return flatten_threads(pages.select("conv_id", payload.alias("payload")), "payload")


@query("page_fields", r"""
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
       regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS lang,
       regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS h1,
       len(regexp_extract_all(html, '<a href='))::INT AS links,
       regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)/', 1) AS department,
       regexp_extract(html, '^<!DOCTYPE (\w+)', 1) AS type,
       coalesce(try_cast(nullif(regexp_extract(html, 'track\((\d+)\)', 1), '') AS INT), -1) AS views,
       coalesce(try_cast(nullif(regexp_extract(url, '/(\d+)(?:[?#]|$)', 1), '') AS INT), -1) AS number,
       round(octet_length(encode(html)) / 1024.0, 6) AS size_kb
FROM pages
""")
def page_fields_query(spark, sf):
    pages = table(spark, sf, "pages")
    fields = page_fields(F.col("html"), F.col("url"))
    return pages.select("page_id", *[c.alias(n) for n, c in fields.items()])


@query("progress_parse", """
SELECT event_id, CASE event_type WHEN 'purchase' THEN 1.0 WHEN 'error' THEN 0.0 WHEN 'signup' THEN 0.0
                 ELSE (floor(value)::INT % 101) / 100.0 END::DOUBLE AS progress FROM events
""")
def progress_parse(spark, sf):
    """Status cells as a page would show them: finished text, a gradient, a broken style, none at all."""
    e = table(spark, sf, "events")
    kind = F.col("event_type")
    stop = (F.floor("value") % 101).cast("string")
    gradient = F.concat(
        F.lit("background: linear-gradient(to right, #29b 0%, #29b "), stop, F.lit("%, #eee "), stop, F.lit("%, #eee 100%)")
    )
    cells = e.select(
        "event_id",
        F.when(kind == "purchase", F.lit(S.FINISHED)).alias("status"),
        F.when(kind == "error", F.lit("background: none")).when(kind != "signup", gradient).alias("style"),
    )
    return cells.select("event_id", S.progress(F.col("status"), F.col("style")).alias("progress"))


@query("safe_cast", """
SELECT p_partkey, coalesce(try_cast(split_part(p_brand, '#', 2) AS INT), -1) AS brand_no,
       coalesce(try_cast(p_name AS INT), -1) AS name_no,
       CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS views,
       CASE WHEN p_type <> 'PROMO' THEN p_type ELSE '' END AS department FROM part
""")
def safe_cast(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey",
        S.safe_int(F.substring_index("p_brand", "#", -1), -1).alias("brand_no"),
        S.safe_int(F.col("p_name"), -1).alias("name_no"),
        F.when(F.col("p_size") > 10, F.col("p_size")).alias("views"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("department"),
    )
    return record_defaults(p, {"views": 0, "department": ""})


@query("date_formats", """
SELECT o_orderkey, o_orderdate::DATE AS d_pattern,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS d_month_name,
       CASE WHEN o_orderstatus = 'F' THEN '-'
            ELSE day(o_orderdate) || '.' || month(o_orderdate) || '.' || year(o_orderdate) END AS s_unpadded
FROM orders
""", days=["d_pattern", "d_month_name"])
def date_formats(spark, sf):
    day = F.col("o_orderdate").cast("date")
    texts = table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(day, "dd.MM.yyyy").alias("padded"),
        F.concat_ws(
            " ", F.dayofmonth(day), F.when(F.col("o_orderstatus") == "P", "brumaire").otherwise(S.month_name(day)),
            F.year(day),
        ).alias("named"),
        F.when(F.col("o_orderstatus") != "F", day).alias("day"),
    )
    return texts.select(
        "o_orderkey",
        S.parse_date(F.col("padded")).alias("d_pattern"),
        S.parse_month_name_date(F.col("named")).alias("d_month_name"),
        S.unpadded_date(F.col("day")).alias("s_unpadded"),
    )


@query("valid_records", """
SELECT count(*) FILTER (o_orderstatus <> 'P') AS valid_cnt, count(*) FILTER (o_orderstatus = 'P') AS corrupted_cnt
FROM orders
""")
def valid_records(spark, sf):
    broken = F.when(F.col("o_orderstatus") == "P", F.lit(R.CORRUPTED_ID)).otherwise(F.col("o_orderkey"))
    return R.validity_counts(table(spark, sf, "orders").select(broken.alias("id")), "id")


@query("date_window", """
SELECT 'absolute' AS kind, count(*) AS cnt, sum(o_totalprice::DECIMAL(18, 2))::DOUBLE AS total FROM orders
WHERE o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
UNION ALL
SELECT 'period', count(*), sum(o_totalprice::DECIMAL(18, 2))::DOUBLE FROM orders
WHERE o_orderdate::DATE >= (SELECT max(o_orderdate)::DATE - 30 FROM orders)
""")
def date_window_query(spark, sf):
    orders = table(spark, sf, "orders")
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")

    def count(kind, rows):
        return rows.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("cnt"), total)

    year = date_window(orders, "o_orderdate", datetime.datetime(1996, 1, 1), datetime.datetime(1996, 12, 31))
    return count("absolute", year).unionByName(count("period", date_window(orders, "o_orderdate", period_days=30)))


@query("capped_records", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P' ORDER BY o_orderkey LIMIT 100
""")
def capped_records(spark, sf):
    """The cap on the number of collected records is the feature."""
    rows = capped(table(spark, sf, "orders"), F.col("o_orderstatus") != "P", ["o_orderkey"], 100)
    return rows.select("o_orderkey", "o_totalprice")


@query("enrich_records", """
SELECT o_orderkey, coalesce(c_name, '') AS author, coalesce(c_mktsegment, '-') AS segment
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
""")
def enrich_records(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("id"))
    extra = table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("author"), F.col("c_mktsegment").alias("segment")
    )
    return R.enrich(orders, extra, "id", {"author": "", "segment": "-"}).drop("id")
