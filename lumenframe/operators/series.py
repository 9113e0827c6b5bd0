"""Operators on many time series at once: ``keys, time, y``.

A series is a table bucketed by time, so its length is bounded by the calendar and not by the
number of raw rows; raw rows only meet mergeable aggregates. Windows run per series.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.operators.joins import join_keys


def _by(keys: Sequence[str], time: str):
    return Window.partitionBy(*keys).orderBy(time)


def bucket_start(time: Column, origin: Column, days: int) -> Column:
    """First day of the bucket of ``days`` days that holds ``time``, counted from ``origin``."""
    n = F.floor(F.datediff(time.cast("date"), origin) / days).cast("int")
    return F.date_add(origin, n * days)


def first_day(df: DataFrame, time: str) -> Column:
    return df.agg(F.min(F.col(time).cast("date"))).scalar()


def bucket_sum(df: DataFrame, keys: Sequence[str], time: str, value: Column, days: int) -> DataFrame:
    """``keys, week, y``: sum of ``value`` per bucket."""
    week = bucket_start(F.col(time), first_day(df, time), days)
    return df.groupBy(*keys, week.alias("week")).agg(F.sum(value).alias("y"))


def resample_first(
    df: DataFrame, keys: Sequence[str], time: str, tie: str, value: str, days: int
) -> DataFrame:
    """``keys, bin_start, first``: first value by (time, tie) in each bin from the first day on.

    Bins are closed on the left; empty bins between the first and last day are kept with null.
    """
    span = df.agg(
        F.struct(F.min(F.col(time).cast("date")).alias("a"), F.max(F.col(time).cast("date")).alias("b"))
    ).scalar()
    found = df.groupBy(*keys, bucket_start(F.col(time), span["a"], days).alias("bin_start")).agg(
        F.min_by(value, F.struct(time, tie)).alias("first")
    )
    every = found.select(*keys).distinct().withColumn("_bins", F.sequence(span["a"], span["b"], F.expr(f"interval {days} days")))
    every = every.select(*keys, F.explode("_bins").alias("bin_start"))
    return join_keys(every, found, [*keys, "bin_start"], "left")


def lagged(y: Column, n: int, keys: Sequence[str], time: str, fill: float | None = None) -> Column:
    return F.lag(y, n, fill).over(_by(keys, time))


def difference(df: DataFrame, keys: Sequence[str], time: str, y: str, n: int, out: str) -> DataFrame:
    """y minus its value n rows before, null at the head."""
    return df.withColumn(out, F.col(y) - lagged(F.col(y), n, keys, time))


def shift(df: DataFrame, keys: Sequence[str], time: str, y: str, n: int, out: str, crop: bool = False) -> DataFrame:
    """y of n rows before; null at the head, or the head cut off."""
    w = _by(keys, time)
    moved = df.select("*", F.lag(y, n).over(w).alias(out), F.row_number().over(w).alias("_pos"))
    return (moved.filter(F.col("_pos") > n) if crop else moved).drop("_pos")


def difference_levels(df: DataFrame, keys: Sequence[str], time: str, y: str, d: int, seasonal_d: int, season: int) -> DataFrame:
    """Columns ``_d0 .. _dd`` (plain differences) and ``_s0 .. _sD`` (seasonal ones of ``_dd``)."""
    out = df.withColumn("_d0", F.col(y))
    for i in range(d):
        out = difference(out, keys, time, f"_d{i}", 1, f"_d{i + 1}")
    out = out.withColumn("_s0", F.col(f"_d{d}"))
    for i in range(seasonal_d):
        out = difference(out, keys, time, f"_s{i}", season, f"_s{i + 1}")
    return out


def seasonal_diff(df: DataFrame, keys: Sequence[str], time: str, y: str, d: int, seasonal_d: int, season: int) -> DataFrame:
    """y differenced d times at lag 1 and D times at the season; the head rows are dropped."""
    levels = difference_levels(df, keys, time, y, d, seasonal_d, season)
    placed = levels.withColumn("_pos", F.row_number().over(_by(keys, time)))
    kept = placed.filter(F.col("_pos") > d + seasonal_d * season)
    return kept.select(*keys, time, F.col(f"_s{seasonal_d}").alias(y))


def lag_columns(p: int, seasonal_p: int, season: int) -> dict[str, int]:
    """Names and lags of a seasonal design: 1..p, each seasonal lag, and 1..p behind each seasonal lag."""
    lags = {f"l{i}": i for i in range(1, p + 1)}
    lags |= {f"s{k * season}": k * season for k in range(1, seasonal_p + 1)}
    return lags | {f"m{k * season}_{i}": k * season + i for k in range(1, seasonal_p + 1) for i in range(1, p + 1)}


def lag_matrix(df: DataFrame, keys: Sequence[str], time: str, y: str, lags: dict[str, int]) -> DataFrame:
    """One column per lag, zero before the start of the series."""
    return df.select("*", *[lagged(F.col(y), n, keys, time, 0.0).alias(c) for c, n in lags.items()])


def inverse_diff(
    df: DataFrame, keys: Sequence[str], time: str, step: str, start: str, stride: int, out: str, log: bool = False
) -> DataFrame:
    """Levels from differences: running sum of ``step`` at the stride, from ``start`` in the first rows."""
    placed = df.withColumn("_pos", F.row_number().over(_by(keys, time)) - 1)
    first = F.when(F.col("_pos") < stride, F.col(start)).otherwise(F.col(step))
    phases = Window.partitionBy(*keys, F.col("_pos") % stride).orderBy(time)
    level = F.sum(first).over(phases.rowsBetween(Window.unboundedPreceding, 0))
    return placed.withColumn(out, F.exp(level) if log else level).drop("_pos")


def integrate_predictions(
    df: DataFrame, keys: Sequence[str], time: str, y: str, pred: str, out: str, d: int, seasonal_d: int, season: int
) -> DataFrame:
    """Level of a predicted difference: plus the lagged level of every difference order below it."""
    rows = difference_levels(df, keys, time, y, d, seasonal_d, season)
    terms = [lagged(F.col(f"_d{i}"), 1, keys, time) for i in range(d)]
    terms += [lagged(F.col(f"_s{i}"), season, keys, time) for i in range(seasonal_d)]
    level = functools.reduce(operator.add, terms, F.col(pred))
    return rows.select(*df.columns, level.alias(out))


def decompose(df: DataFrame, keys: Sequence[str], time: str, y: str, period: int) -> DataFrame:
    """Additive decomposition: ``trend, seasonal, resid``; null where the centred frame is not full."""
    w = _by(keys, time)
    half = period // 2
    full = F.count(y).over(w.rowsBetween(-half, half)) == 2 * half + 1
    if period % 2:
        mean = F.avg(y).over(w.rowsBetween(-half, half))
    else:
        inner = F.sum(y).over(w.rowsBetween(-half + 1, half - 1)) if half > 1 else F.col(y)
        ends = F.lag(y, half).over(w) + F.lead(y, half).over(w)
        mean = (inner + ends / 2) / period
    rows = df.select(
        "*", F.when(full, mean).alias("trend"), ((F.row_number().over(w) - 1) % period).alias("_phase")
    )
    phases = rows.groupBy(*keys, "_phase").agg(F.avg(F.col(y) - F.col("trend")).alias("_m"))
    centred = phases.select(
        *keys, "_phase", (F.col("_m") - F.avg("_m").over(Window.partitionBy(*keys))).alias("seasonal")
    )
    joined = join_keys(rows, centred, [*keys, "_phase"])
    return joined.select(*df.columns, "trend", "seasonal", (F.col(y) - F.col("trend") - F.col("seasonal")).alias("resid"))


def autocorrelation(df: DataFrame, keys: Sequence[str], time: str, y: str, max_lag: int) -> DataFrame:
    """``keys, lag, r`` for lags 0..max_lag, biased: both sums over the whole series."""
    mean = F.avg(y).over(Window.partitionBy(*keys))
    rows = df.select(*keys, F.row_number().over(_by(keys, time)).alias("_pos"), (F.col(y) - mean).alias("_c"))
    ahead = rows.select(
        *keys, F.col("_c").alias("_a"), F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"), "_pos"
    ).withColumn("_pos", F.col("_pos") + F.col("lag"))
    sums = join_keys(ahead, rows, [*keys, "_pos"]).groupBy(*keys, "lag").agg(F.sum(F.col("_a") * F.col("_c")).alias("_s"))
    base = F.max(F.when(F.col("lag") == 0, F.col("_s"))).over(Window.partitionBy(*keys))
    return sums.select(*keys, "lag", F.try_divide(F.col("_s"), F.nullif(base, F.lit(0.0))).alias("r"))


def combine_first(a: DataFrame, b: DataFrame, on: Sequence[str], y: str) -> DataFrame:
    """Rows of both series, one for each place; where both have a value the first wins. A null key is a key like others."""
    sides = [df.select(*on, F.col(y).alias("_v"), F.lit(i).alias("_side")) for i, df in enumerate((a, b))]
    known = F.when(F.col("_v").isNotNull(), F.col("_side"))
    return sides[0].unionByName(sides[1]).groupBy(*on).agg(F.min_by("_v", known).alias(y))


def ar1_forecast(df: DataFrame, keys: Sequence[str], time: str, y: str, steps: int) -> DataFrame:
    """``keys, h, y_hat``: mean + phi^h (last - mean), phi by least squares on the centred series."""
    c = F.col(y) - F.avg(y).over(Window.partitionBy(*keys))
    rows = df.select(*keys, time, F.col(y).alias("_y"), c.alias("_c"))
    rows = rows.withColumn("_p", lagged(F.col("_c"), 1, keys, time))
    fit = rows.groupBy(*keys).agg(
        F.avg("_y").alias("_mean"),
        F.max_by("_c", time).alias("_last"),
        F.try_divide(F.sum(F.col("_c") * F.col("_p")), F.sum(F.col("_p") * F.col("_p"))).alias("_phi"),
    )
    ahead = fit.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    return ahead.select(*keys, "h", (F.col("_mean") + F.pow("_phi", F.col("h").cast("double")) * F.col("_last")).alias("y_hat"))
