"""Parquet tables by name."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` over at least one task per core, for costly work per row such as splitting texts.

    A scan that already has that many tasks is left as it is; a few small files are shuffled once.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def right_sized(df: DataFrame, rows_per_task: int = 5000) -> DataFrame:
    """Fewer tasks for a small table, as an iterative fit pays for each task in every step; a large one is left alone."""
    wanted = max(1, math.ceil(df.count() / rows_per_task))
    return df.coalesce(wanted) if wanted < df.rdd.getNumPartitions() else df
