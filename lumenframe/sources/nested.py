"""Nested JSON pages of comment threads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_SCHEMA = (
    "struct<items: array<struct<snippet: struct<topLevelComment: struct<snippet: "
    "struct<authorDisplayName: string, publishedAt: string, textDisplay: string>>>>>, nextPageToken: string>"
)


def flatten_threads(df: DataFrame, payload: str) -> DataFrame:
    """One row per comment in the JSON pages of ``payload``: ``author, date, time, comment`` as strings."""
    others = [c for c in df.columns if c != payload]
    page = F.from_json(F.col(payload), PAGE_SCHEMA)
    items = df.select(*others, F.explode(page["items"]).alias("_item"))
    c = F.col("_item.snippet.topLevelComment.snippet")
    return items.select(
        *others,
        c["authorDisplayName"].alias("author"),
        F.substring_index(c["publishedAt"], "T", 1).alias("date"),
        c["publishedAt"].alias("time"),
        c["textDisplay"].alias("comment"),
    )


def thread_item(author: Column, time: Column, text: Column) -> Column:
    """One item of a page."""
    comment = F.struct(author.alias("authorDisplayName"), time.alias("publishedAt"), text.alias("textDisplay"))
    top = F.struct(comment.alias("snippet"))
    return F.struct(F.struct(top.alias("topLevelComment")).alias("snippet"))
