"""Registry of queries and of the SQL that states the same result."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, days: Sequence[str] = ()) -> Callable[[Query], Query]:
    """Register a query and its SQL. The columns in ``days`` are given as 'yyyy-mm-dd' text on both sides."""

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = _with_day_texts(fn, days) if days else fn
        if sql is not None:
            texts = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in days)
            ORACLES[name] = f"SELECT * REPLACE ({texts}) FROM ({sql})" if days else sql
        return fn

    return keep


def _with_day_texts(fn: Query, days: Sequence[str]) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(spark, folder).withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in days})

    return run
