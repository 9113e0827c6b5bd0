"""Exact split scan, level-wise trees and boosting rounds."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.impurity import gain
from lumenframe.operators.position import running_sums
from lumenframe.operators.prep import categories
from lumenframe.sources.scratch import materialize, release

MAX_CLASSES = 200
MAX_DEPTH = 30
# gains are compared after rounding, so that the order of a sum does not choose the split
GAIN_DIGITS = 9


def split_candidates(
    df: DataFrame, nodes: Sequence[str], features: Sequence[Column], label: str, weight: Column, criterion: str, classes: Sequence
) -> DataFrame:
    """``nodes, feature, thr, gain, n_left, n`` for every place where the value of a feature changes.

    Rows are folded to (node, feature, value) class totals, then summed in order over ranges of
    them: the scan of one feature is spread over many tasks.
    """
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), c.cast("double").alias("value")) for i, c in enumerate(features)])
    long = df.select(*nodes, F.col(label).alias("_y"), weight.cast("double").alias("_w"), F.inline(pairs))
    ws = [f"w{i}" for i in range(len(classes))]
    folded = long.filter(F.col("value").isNotNull()).groupBy(*nodes, "feature", "value").agg(
        *[F.sum(F.when(F.col("_y") == F.lit(c), F.col("_w")).otherwise(0.0)).alias(w) for w, c in zip(ws, classes)],
        F.count(F.lit(1)).alias("n"),
    )
    scanned = running_sums(folded, [*nodes, "feature"], ["value"], [*ws, "n"], following="value", totals=True)
    left, total = [F.col(f"cum_{w}") for w in ws], [F.col(f"tot_{w}") for w in ws]
    return scanned.filter(F.col("next_value").isNotNull()).select(
        *nodes,
        "feature",
        ((F.col("value") + F.col("next_value")) / 2).alias("thr"),
        gain(criterion, left, total).alias("gain"),
        F.col("cum_n").alias("n_left"),
        F.col("tot_n").alias("n"),
    )


def best_splits(candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The greatest gain above 0 per key; ties to the lower feature, then the lower threshold."""
    rounded = F.round("gain", GAIN_DIGITS)
    order = F.struct((-rounded).alias("g"), "feature", "thr")
    row = F.struct("feature", "thr", "gain", "n_left", "n")
    best = candidates.filter(rounded > 0).groupBy(*keys).agg(F.min_by(row, order).alias("b"))
    return best.select(*keys, *[F.col(f"b.{c}").alias(c) for c in ("feature", "thr", "gain", "n_left", "n") if c not in keys])


def grow_tree(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    depth: int,
    criterion: str = "gini",
    min_split: int = 2,
    min_leaf: int = 1,
    weight: str | None = None,
) -> DataFrame:
    """Exact classification tree, all nodes of a level in one pass: ``node, feature, thr, n, cls``.

    The root is node 1, the children of i are 2i (value below the threshold) and 2i + 1. Leaves have
    no feature. The rows carry their node and are written once per level, so that no level replays those before it.
    """
    if not 0 <= depth <= MAX_DEPTH:
        raise ValueError(f"depth must lie in 0..{MAX_DEPTH}")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    classes = categories(df, label, MAX_CLASSES)
    rows = materialize(
        df.select(
            F.array(*[F.col(f).cast("double") for f in features]).alias("x"),
            F.col(label).alias("y"), w.alias("w"), F.lit(1).cast("long").alias("node"),
        ),
        "rows",
    )
    names = F.array(*[F.lit(f) for f in features])
    levels: list[DataFrame] = []
    for level in range(depth + 1):
        per_class = rows.groupBy("node", "y").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))
        stats = per_class.groupBy("node").agg(
            F.sum("n").alias("n"), F.min(F.struct((-F.col("w")).alias("w"), "y"))["y"].alias("cls")
        )
        if level == depth:
            leaf = stats.select("node", F.lit(None).cast("string").alias("feature"), F.lit(None).cast("double").alias("thr"), "n", "cls")
            levels.append(materialize(leaf, "level"))
            break
        x = [F.get(F.col("x"), F.lit(i)) for i in range(len(features))]
        found = best_splits(split_candidates(rows, ["node"], x, "y", F.col("w"), criterion, classes), ["node"])
        allowed = found.filter(
            (F.col("n") >= min_split) & (F.col("n_left") >= min_leaf) & (F.col("n") - F.col("n_left") >= min_leaf)
        )
        splits = materialize(allowed.select("node", "feature", "thr"), "splits")
        known = stats.join(splits, "node", "left").select("node", F.get(names, F.col("feature")).alias("feature"), "thr", "n", "cls")
        levels.append(materialize(known, "level"))
        if splits.isEmpty():
            break
        side = F.when(F.get(F.col("x"), F.col("feature")) < F.col("thr"), 0).otherwise(1)
        before, moved = rows, rows.join(splits, "node").select("x", "y", "w", (F.col("node") * 2 + side).alias("node"))
        rows = materialize(moved, "rows")
        release(before)
    tree = levels[0]
    for more in levels[1:]:
        tree = tree.unionByName(more)
    return materialize(tree, "tree")


def tree_predict(df: DataFrame, tree: DataFrame, depth: int, out: str = "pred") -> DataFrame:
    """Column ``out``: the class of the leaf each row falls into. ``tree`` is as made by :func:`grow_tree`."""
    features = [r[0] for r in tree.select("feature").filter("feature IS NOT NULL").distinct().collect()]
    value = F.coalesce(*[F.when(F.col("_f") == f, F.col(f).cast("double")) for f in features], F.lit(None).cast("double"))
    rows = df.withColumn("_node", F.lit(1).cast("long")).withColumn(out, F.lit(None).cast(tree.schema["cls"].dataType))
    for _ in range(depth + 1):
        step = tree.select(F.col("node").alias("_node"), F.col("feature").alias("_f"), F.col("thr").alias("_t"), F.col("cls").alias("_c"))
        side = F.when(value < F.col("_t"), 0).otherwise(1)
        rows = rows.join(step, "_node", "left").select(
            *df.columns,
            F.when(F.col("_f").isNotNull(), F.col("_node") * 2 + side).alias("_node"),
            F.coalesce(F.col(out), F.when(F.col("_f").isNull(), F.col("_c"))).alias(out),
        )
    return rows.drop("_node")


def class_shares(df: DataFrame, label: str, weight: str) -> DataFrame:
    sums = df.groupBy(label).agg(F.sum(weight).alias("_w"))
    total = df.agg(F.sum(weight).cast("double")).scalar()
    return sums.select(F.col(label).alias("class"), F.try_divide(F.col("_w"), total).alias("share"))


def samme_alpha(error: float, classes: int, clip: float = 1e-9) -> float:
    """Vote weight of a weak classifier; the error is clipped away from 0 and 1."""
    e = min(max(error, clip), 1 - clip)
    return math.log((1 - e) / e) + math.log(classes - 1)


def weighted_error(df: DataFrame, label: str, pred: str, weight: str) -> float:
    miss = F.when(F.col(label) != F.col(pred), F.col(weight)).otherwise(0.0)
    row = df.agg(F.sum(miss).alias("m"), F.sum(weight).alias("t")).first()
    return row["m"] / row["t"]


def samme_reweight(df: DataFrame, label: str, pred: str, weight: str, alpha: float) -> DataFrame:
    """Weights of missed rows times exp(alpha), then all divided by their sum (one aggregate, no window)."""
    raised = F.when(F.col(label) != F.col(pred), F.col(weight) * math.exp(alpha)).otherwise(F.col(weight))
    rows = df.withColumn(weight, raised)
    total = rows.agg(F.sum(weight)).scalar()
    return rows.withColumn(weight, F.col(weight) / total)
