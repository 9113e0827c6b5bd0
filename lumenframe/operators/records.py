"""Record validity and enrichment."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORRUPTED_ID = -1


def is_valid(record_id: Column) -> Column:
    return record_id != CORRUPTED_ID


def validity_counts(df: DataFrame, record_id: str) -> DataFrame:
    """Valid and corrupted records in one pass."""
    ok = is_valid(F.col(record_id))
    return df.agg(F.count_if(ok).alias("valid_cnt"), F.count_if(~ok).alias("corrupted_cnt"))


def enrich(df: DataFrame, extra: DataFrame, on: str, defaults: Mapping[str, object]) -> DataFrame:
    """Left join of ``extra`` on an id; gaps keep the default of the column."""
    columns = extra.select(on, *defaults)
    joined = df.join(columns, on, "left")
    return joined.select(*df.columns, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()])
