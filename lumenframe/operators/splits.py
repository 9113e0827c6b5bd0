"""Holdout splits, sampling and row slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.operators.joins import join_keys
from lumenframe.operators.position import order_statistics, running_sums
from lumenframe.sources.scratch import materialize


def holdout_ordered(df: DataFrame, key: str, part: float) -> DataFrame:
    """Column ``part``: the last ceil(n * part) rows by the unique ``key`` are 'test', the rest 'train'.

    The cut is found first, as one value, so that a filter on the part becomes a filter on the key
    that reaches the scan.
    """
    found = order_statistics(df, [], key, {"cut": (1 - part, lambda n: n - F.ceil(n * part))}).first()
    cut = F.lit(found["lo"] if found else None)
    return df.withColumn("part", F.when(F.col(key) < cut, F.lit("train")).otherwise(F.lit("test")))


def hash_bucket(key: Column, seed: int, buckets: int = 100) -> Column:
    """Bucket of a row by an md5 prefix of key and seed: independent of partitioning and engine."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets


def holdout_hashed(df: DataFrame, key: str, train_percent: int, seed: int = 42) -> DataFrame:
    bucket = hash_bucket(F.col(key), seed)
    return df.withColumn("part", F.when(bucket < train_percent, F.lit("train")).otherwise(F.lit("test")))


def holdout_chrono(
    df: DataFrame, series: Sequence[str], time: str, tie: str, train_part: float = 0.8, rounding: str = "ceil"
) -> DataFrame:
    """Column ``part``: first ceil (or floor) of n * train_part rows of every series by (time, tie) are 'train'.

    The cut is found as an order statistic of the time, then of the tie-breaker among the rows of
    the cut time, so that no series is sorted in one task. Null is a series of its own; rows without a time are 'test'.
    """
    series = list(series)
    size = {"ceil": F.ceil, "floor": F.floor}[rounding]

    def last_train(n: Column) -> Column:
        return F.greatest(size(n * train_part) - 1, F.lit(0))

    cut = order_statistics(df, series, time, {"cut": (train_part, last_train)})
    cut = materialize(cut.select(*series, F.col("lo").alias("_cut_time")), "cuts")
    marked = join_keys(df, cut, series, "left")
    counts = marked.groupBy(*series).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col(time) < F.col("_cut_time")).alias("_before"),
    )
    need = counts.select(*series, (size(F.col("_n") * train_part) - F.col("_before")).alias("_need"))
    at_cut = join_keys(marked.filter(F.col(time) == F.col("_cut_time")), need, series)
    tie_rank = at_cut.groupBy(*series, "_need", tie).agg(F.count(F.lit(1)).alias("_c"))
    # the rows of one instant of one series: rank by tie through a second order statistic
    tie_cut = materialize(_rank_value(tie_rank, series, tie), "cuts")
    placed = join_keys(marked, tie_cut, series, "left")
    train = (F.col(time) < F.col("_cut_time")) | (
        (F.col(time) == F.col("_cut_time")) & (F.col("_need") > 0) & (F.col(tie) <= F.col("_tie_cut"))
    )
    return placed.select(
        *df.columns, F.when(train, F.lit("train")).otherwise(F.lit("test")).alias("part")
    )


def _rank_value(at_cut: DataFrame, series: list[str], tie: str) -> DataFrame:
    ranked = running_sums(at_cut, series, [tie], ["_c"])
    return ranked.groupBy(*series, "_need").agg(
        F.max(F.when(F.col("cum__c") <= F.col("_need"), F.col(tie))).alias("_tie_cut")
    )


def bootstrap_counts(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Column ``mult``: Poisson(1) multiplicity per row, by inversion of a hashed uniform number.

    The distributed form of n draws with replacement. The distribution is written out until the mass that is left is below the
    resolution of the 48-bit number, so that no multiplicity the number can stand for is cut.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}-bootstrap")))
    u = F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(16**12)
    mass, total, mult = 2.718281828459045**-1, 0.0, F.lit(0)
    k = 0
    while mass > 1 / 16**12:
        total += mass
        mult = mult + F.when(u >= total, F.lit(1)).otherwise(F.lit(0))
        k += 1
        mass /= k
    return df.withColumn("mult", mult)


def oversample(df: DataFrame, condition: Column, copies: int = 2) -> DataFrame:
    """Rows that meet ``condition`` appear ``copies`` times; no shuffle."""
    times = F.when(condition, F.lit(copies)).otherwise(F.lit(1))
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def capped(df: DataFrame, valid: Column, order: Sequence[str], n: int) -> DataFrame:
    """At most n valid rows, in order: filter, then a distributed top-n."""
    return first_rows(df.filter(valid), order, n)


def date_window(df: DataFrame, time: str, start=None, end=None, period_days: int | None = None) -> DataFrame:
    """Rows between two dates (end after start), or within a period before the latest date."""
    if start is not None and end is not None:
        if end <= start:
            raise ValueError("the end of the window must lie after its start")
        return df.filter(F.col(time).between(F.lit(start), F.lit(end)))
    if period_days is None or period_days <= 0:
        raise ValueError("give two dates or a positive period")
    newest = df.agg(F.max(F.col(time).cast("date"))).scalar()
    return df.filter(F.col(time).cast("date") >= F.date_sub(newest, period_days))
