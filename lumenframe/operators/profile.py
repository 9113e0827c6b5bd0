"""Column profiles, distributions, correlations and standard scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.operators.joins import join_keys
from lumenframe.operators.position import exact_quantiles
from lumenframe.sources.scratch import materialize

QUARTILES = {"q1": 0.25, "q2": 0.5, "q3": 0.75}


def long_form(df: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    """``col, value``: one row per row and column."""
    wide = df.select(*[F.col(c).cast(cast).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "col", "value")


def column_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``col, dtype, cnt, mean, std, min, q1, q2, q3, max, rng`` per numeric column; cnt is non-null rows."""
    values = long_form(df, cols, "double")
    basic = values.groupBy("col").agg(
        F.count("value").alias("cnt"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
    )
    types = dict(df.dtypes)
    dtype = F.create_map(*[F.lit(x) for c in cols for x in (c, types[c])])
    # the ends in the column's own type: the difference of two large whole numbers is exact
    ends = [F.struct(F.lit(c).alias("col"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
                     (F.max(c) - F.min(c)).cast("double").alias("rng")).alias(f"_{i}") for i, c in enumerate(cols)]
    ends = df.agg(*ends).select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(cols))])))
    found = basic.join(exact_quantiles(values, ["col"], "value", QUARTILES), "col", "left").join(ends, "col")
    return found.select("col", dtype[F.col("col")].alias("dtype"), "cnt", "mean", "std", "min", "q1", "q2", "q3", "max", "rng")


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``col, value, cnt``, values as text."""
    return long_form(df, cols, "string").groupBy("col", "value").agg(F.count(F.lit(1)).alias("cnt"))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``col, n_distinct`` without null: folded per value first, so a frequent value costs one row."""
    values = distinct_values(df, cols).filter(F.col("value").isNotNull())
    return values.groupBy("col").agg(F.count(F.lit(1)).alias("n_distinct"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``a, b, r`` for every ordered pair, from one aggregation of one row."""
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    both = [(a, b, f"{a}|{b}") for a, b in pairs] + [(b, a, f"{a}|{b}") for a, b in pairs if a != b]
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{n}`").alias("r")) for a, b, n in both]
    return row.select(F.inline(F.array(*cells)))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """``bin, lo, cnt`` of equal-width bins; the last bin is closed, empty bins are kept."""
    value = F.col(col).cast("double")
    ends = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    flat = ends["lo"] == ends["hi"]
    lo = F.when(flat, ends["lo"] - 0.5).otherwise(ends["lo"])
    width = F.when(flat, F.lit(1.0) / bins).otherwise((ends["hi"] - ends["lo"]) / bins)
    found = df.filter(value.isNotNull()).select(
        F.least(F.floor((value - lo) / width), F.lit(bins - 1)).cast("int").alias("bin")
    )
    counts = found.groupBy("bin").agg(F.count(F.lit(1)).alias("cnt"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (lo + F.col("bin") * width).alias("lo"), F.coalesce("cnt", F.lit(0)).alias("cnt")
    )


def box_summary(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """Quartiles, the furthest values within 1.5 IQR, and the count beyond them, per key."""
    quartiles = materialize(exact_quantiles(df, keys, col, QUARTILES), "quartiles")
    iqr = F.col("q3") - F.col("q1")
    v = F.col(col)
    low, high = F.col("q1") - iqr * 1.5, F.col("q3") + iqr * 1.5
    return join_keys(df, quartiles, keys).groupBy(*keys, "q1", "q2", "q3").agg(
        F.min(F.when(v >= low, v)).alias("lo"),
        F.max(F.when(v <= high, v)).alias("hi"),
        F.count_if((v < low) | (v > high)).alias("n_out"),
    )


def zscore(df: DataFrame, keys: Sequence[str], col: str, out: str = "z") -> DataFrame:
    """Standard score with the population deviation per key; null where the deviation is 0.

    Two aggregates per key are joined back, so a frequent key is never one window partition.
    """
    stats = df.groupBy(*keys).agg(F.avg(col).alias("_mean"), F.stddev_pop(col).alias("_dev"))
    if keys:
        rows = join_keys(df, materialize(stats, "moments"), keys)
    else:
        one = stats.select(F.struct("_mean", "_dev")).scalar()
        rows = df.withColumn("_mean", one["_mean"]).withColumn("_dev", one["_dev"])
    z = F.try_divide(F.col(col) - F.col("_mean"), F.nullif(F.col("_dev"), F.lit(0.0)))
    return rows.withColumn(out, z).drop("_mean", "_dev")


def standardize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns with mean 0 and population deviation 1 over the table; a constant column becomes 0."""
    cols = list(cols)
    moments = [F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols]
    one = df.agg(F.struct(*moments)).scalar()
    scaled = {
        c: F.coalesce(F.try_divide(F.col(c) - one[c]["m"], F.nullif(one[c]["s"], F.lit(0.0))), F.lit(0.0)).alias(c)
        for c in cols
    }
    return df.select(*[scaled.get(c, F.col(c)) for c in df.columns])
