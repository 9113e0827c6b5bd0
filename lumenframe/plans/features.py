"""Shape features of the labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.functions.tokens import WORD, letters
from lumenframe.operators.profile import standardize
from lumenframe.sources.scratch import materialize
from lumenframe.sources.tables import spread, table

SHAPE = ("n_chars", "words", "line_cnt", "mean_len")

DOCX_SQL = r"""
docx AS (SELECT doc_id, n_chars::DOUBLE AS n_chars, len(regexp_extract_all(text, '[\p{L}\p{N}_]+'))::DOUBLE AS words,
                (length(text) - length(replace(text, chr(10), '')) + 1)::DOUBLE AS line_cnt,
                coalesce(length(regexp_replace(text, '[^\p{L}\p{N}_]+', '', 'g'))
                         / nullif(len(regexp_extract_all(text, '[\p{L}\p{N}_]+')), 0), 0)::DOUBLE AS mean_len,
                quality FROM documents JOIN labels USING (doc_id))"""
DOCZ_SQL = DOCX_SQL + """,
docz AS (SELECT doc_id, quality, """ + ", ".join(
    f"(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0)) AS {c}" for c in SHAPE
) + " FROM docx)"


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id and text, spread over the cores."""
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def doc_shape(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, the four SHAPE columns as doubles, quality; written once, as the texts are costly to scan again."""
    text = F.col("text")
    words = F.regexp_count(text, F.lit(WORD)).cast("double")
    docs = spread(table(spark, sf, "documents").select("doc_id", "text", "n_chars"), "doc_id").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        words.alias("words"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("double").alias("line_cnt"),
        F.coalesce(F.try_divide(F.length(letters(text)), words), F.lit(0.0)).alias("mean_len"),
    )
    return materialize(docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id"), "shapes")


def doc_shape_scaled(spark: SparkSession, sf: str) -> DataFrame:
    return standardize(doc_shape(spark, sf), SHAPE)
