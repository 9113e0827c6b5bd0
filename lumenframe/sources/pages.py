"""Fields of a record card from raw page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenframe.functions.scalars import safe_int, size_kb

# Where each field stands in the page.
TITLE = r"<title>([^<]*)</title>"
LANG = r'<html[^>]* lang="([^"]*)"'
HEADING = r"<h1>([^<]*)</h1>"
LINK = r"<a href="
HOST = r"^[a-z]+://([^/]+)"
NUMBER = r"/(\d+)(?:[?#]|$)"
DEPARTMENT = r"^[a-z]+://[^/]+/([^/?#]+)/"
KIND = r"^<!DOCTYPE (\w+)"
VIEWS = r"track\((\d+)\)"


def page_fields(html: Column, url: Column) -> dict[str, Column]:
    """Title, language, heading, link count, host, department, type, views and record number (-1 if none) and size in KB."""
    return {
        "title": F.regexp_extract(html, TITLE, 1),
        "lang": F.regexp_extract(html, LANG, 1),
        "h1": F.regexp_extract(html, HEADING, 1),
        "links": F.regexp_count(html, F.lit(LINK)),
        "host": F.regexp_extract(url, HOST, 1),
        "department": F.regexp_extract(url, DEPARTMENT, 1),
        "type": F.regexp_extract(html, KIND, 1),
        "views": safe_int(F.regexp_extract(html, VIEWS, 1), -1),
        "number": safe_int(F.regexp_extract(url, NUMBER, 1), -1),
        "size_kb": F.round(size_kb(html), 6),
    }
