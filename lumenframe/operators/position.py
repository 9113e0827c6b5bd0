"""Order statistics, running sums and positions over a whole table without a one-task window."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.operators.joins import join_keys
from lumenframe.sources.scratch import materialize

# relative rank error asked of the sketch; tables up to this many rows per key are read exactly
SKETCH_ACCURACY = 10_000
# rank margin around the wanted position, in units of the sketch error
MARGIN = 5

RankOf = Callable[[Column], Column]


def order_statistics(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    targets: dict[str, tuple[float, RankOf]],
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Values at given zero-based ranks per key: ``keys, target, lo, hi, frac``.

    ``targets`` maps a name to (approximate relative rank, exact rank as a function of the row
    count). A mergeable sketch brackets each rank. A second pass keeps the values inside a bracket
    and only counts the rows between brackets; equal values share a slot. The slots are numbered by
    running sums over ranges of them, so that no key has to fit into one task.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    eps = MARGIN / accuracy
    names = list(targets)
    probs = [p for n in names for p in (max(0.0, targets[n][0] - eps), min(1.0, targets[n][0] + eps))]
    stats = rows.groupBy(*keys).agg(
        F.count("_v").alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", probs, accuracy).alias("_cuts"),
    )
    small = F.col("_n") <= accuracy
    limits = [c for i in range(len(names)) for c in (f"_lo{i}", f"_hi{i}", f"_rank{i}")]
    stats = stats.filter("_n > 0").select(
        *keys,
        *[F.when(small, F.col("_min")).otherwise(F.col("_cuts")[2 * i]).alias(f"_lo{i}") for i in range(len(names))],
        *[F.when(small, F.col("_max")).otherwise(F.col("_cuts")[2 * i + 1]).alias(f"_hi{i}") for i in range(len(names))],
        *[targets[n][1](F.col("_n")).cast("double").alias(f"_rank{i}") for i, n in enumerate(names)],
    )
    if keys:
        # written first: its real size decides whether the join is a broadcast
        paired = join_keys(rows, materialize(stats, "brackets"), keys)
    else:
        one = stats.first()  # a few numbers
        paired = rows.select("_v", *[F.lit(one[c] if one else None).alias(c) for c in limits])
    v = F.col("_v")
    spans = [(F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i in range(len(names))]
    inside = functools.reduce(operator.or_, [v.between(lo, hi) for lo, hi in spans])
    passed = functools.reduce(operator.add, [F.when(lo <= v, 1).otherwise(0) for lo, _ in spans])
    slots = paired.groupBy(*keys, passed.alias("_passed"), F.when(inside, v).alias("_in")).agg(
        F.count(F.lit(1)).alias("_c"), F.max("_v").alias("_top"), *[F.max(f"_rank{i}").alias(f"_rank{i}") for i in range(len(names))]
    )
    # a bracket holds a thousandth of the rows of its key, so its slots are summed over ranges as well
    ranged = running_sums(slots, keys, ["_top"], ["_c"]).withColumnRenamed("cum__c", "_end")
    ranged = ranged.withColumn("_start", F.col("_end") - F.col("_c"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_in")))

    found = ranged.groupBy(*keys).agg(
        *[
            F.struct(
                F.lit(name).alias("target"), at(F.floor(f"_rank{i}")).alias("lo"), at(F.ceil(f"_rank{i}")).alias("hi"),
                F.max(F.col(f"_rank{i}") - F.floor(f"_rank{i}")).alias("frac"),
            ).alias(f"_t{i}")
            for i, name in enumerate(names)
        ]
    )
    if not keys:
        found = found.filter("_t0.frac IS NOT NULL")
    out = found.select(*keys, F.inline(F.array(*[f"_t{i}" for i in range(len(names))])))
    missed = F.raise_error(F.lit("rank outside of the sketch bracket"))
    return out.select(
        *keys,
        "target",
        F.when(F.col("lo").isNull() | F.col("hi").isNull(), missed).otherwise(F.col("lo")).alias("lo"),
        "hi",
        "frac",
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """Linearly interpolated quantiles per key, one column per name in ``probs``."""

    def rank(p: float) -> RankOf:
        return lambda n: F.lit(p) * (n - 1)

    rows = df.withColumn("_x", F.col(value).cast("double"))
    stats = order_statistics(rows, keys, "_x", {name: (p, rank(p)) for name, p in probs.items()}, accuracy)
    q = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")
    return stats.groupBy(*keys).agg(
        *[F.max(F.when(F.col("target") == name, q)).alias(name) for name in probs]
    )


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str],
    following: str | None = None,
    totals: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Running sums ``cum_<col>`` per key in ``order``.

    ``following`` adds ``next_<col>``, the value of that column in the next row of the key; ``totals``
    adds ``tot_<col>``, the sum over the whole key.

    (keys, order) must be unique. The rows are range-partitioned once and written; each range is
    summed on its own, and the totals of the ranges before it are added. A key that holds most of
    the rows is therefore spread over many tasks.
    """
    keys, order, sums = list(keys), list(order), list(sums)
    # without a number the ranges follow the size of the data: neighbouring small ones are merged
    by = [*keys, *order]
    ranges = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    ranged = materialize(ranges.withColumn("_pid", F.spark_partition_id()), "ranges")
    head = [F.min_by(following, F.struct(*order)).alias("_head")] if following else []
    per_range = ranged.groupBy("_pid", *keys).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums], *head)
    # one row per range and key
    by_range = Window.partitionBy(*keys).orderBy("_pid")
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        "_pid",
        *keys,
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *([F.lead("_head").over(by_range).alias("_next_head")] if following else []),
        *([F.sum(f"_t_{c}").over(Window.partitionBy(*keys)).alias(f"tot_{c}") for c in sums] if totals else []),
    )
    inside = Window.partitionBy("_pid", *keys).orderBy(*order)
    local = ranged.select(
        "*",
        *[F.sum(c).over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_l_{c}") for c in sums],
        *([F.lead(following).over(inside).alias("_next_in")] if following else []),
    )
    joined = join_keys(local, offsets, ["_pid", *keys])
    return joined.select(
        *df.columns,
        *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in sums],
        *([F.coalesce("_next_in", "_next_head").alias(f"next_{following}")] if following else []),
        *([f"tot_{c}" for c in sums] if totals else []),
    )


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos") -> DataFrame:
    """One-based position per key in ``order``; (keys, order) must be unique."""
    placed = running_sums(df.withColumn("_one", F.lit(1).cast("long")), keys, order, ["_one"])
    return placed.withColumnRenamed("cum__one", name).drop("_one")
