"""Joins that keep rows with null keys."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right`` where all ``keys`` are equal; null equals null."""
    named = right.select(*[F.col(f"`{c}`").alias(f"_right_{c}" if c in keys else c) for c in right.columns])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_right_{k}`")) for k in keys]
    return left.join(named, functools.reduce(operator.and_, same), how).drop(*[f"_right_{k}" for k in keys])
