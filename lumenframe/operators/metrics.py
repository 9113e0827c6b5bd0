"""Scores of predictions, votes, and information criteria."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.operators.position import running_sums


def majority_vote(df: DataFrame, keys: Sequence[str], cls: str, out: str = "voted", weight: str | None = None) -> DataFrame:
    """Class of the greatest (weighted) count per key, ties to the lowest class."""
    share = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.groupBy(*keys, cls).agg(share.alias("_s"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_s")).alias("s"), F.col(cls).alias("c"))).alias("_b"))
    return best.select(*keys, F.col("_b.c").alias(out))


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """``truth, pred, n``; at most classes squared rows."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, truth: str, pred: str) -> DataFrame:
    hit = F.when(F.col(truth) == F.col(pred), 100.0).otherwise(0.0)
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def class_scores(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """``class, precision, recall, f1, support`` per class; 0/0 counts as 0."""
    sides = confusion(df, truth, pred).select(
        "n",
        F.inline(
            F.array(
                F.struct(F.col("truth").alias("class"), F.lit(True).alias("is_truth"), (F.col("truth") == F.col("pred")).alias("hit")),
                F.struct(F.col("pred").alias("class"), F.lit(False).alias("is_truth"), F.lit(False).alias("hit")),
            )
        ),
    )
    n = F.col("n")
    counts = sides.groupBy("class").agg(
        F.sum(F.when(F.col("hit"), n).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("is_truth"), n).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("is_truth"), n).otherwise(0)).alias("predicted"),
    )
    p, r = _ratio(F.col("tp"), F.col("predicted")), _ratio(F.col("tp"), F.col("support"))
    return counts.select(
        "class", p.alias("precision"), r.alias("recall"),
        _ratio(F.col("tp") * 2.0, F.col("predicted") + F.col("support")).alias("f1"), "support",
    )


def classification_report(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Scores per class and a support-weighted row named 'weighted'."""
    per_class = class_scores(df, truth, pred).withColumn("class", F.col("class").cast("string"))
    total = F.sum("support")
    weighted = per_class.agg(
        F.lit("weighted").alias("class"),
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in ("precision", "recall", "f1")],
        total.alias("support"),
    )
    return per_class.unionByName(weighted)


def holdout_scores(df: DataFrame, truth: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Accuracy in percent and support-weighted F1 per key, from one grouping of the predictions."""
    keys = list(keys)
    cells = df.groupBy(*keys, F.col(truth).alias("_t"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    sides = cells.select(
        *keys, "_n",
        F.inline(
            F.array(
                F.struct(F.col("_t").cast("string").alias("_c"), F.lit(1).alias("_is"), (F.col("_t") == F.col("_p")).cast("int").alias("_hit")),
                F.struct(F.col("_p").cast("string").alias("_c"), F.lit(0).alias("_is"), F.lit(0).alias("_hit")),
            )
        ),
    )
    per_class = sides.groupBy(*keys, "_c").agg(
        F.sum(F.col("_n") * F.col("_hit")).alias("tp"),
        F.sum(F.col("_n") * F.col("_is")).alias("support"),
        F.sum("_n").alias("both"),
    )
    f1 = _ratio(F.col("tp") * 2.0, F.col("both"))
    return per_class.groupBy(*keys).agg(
        (F.sum("tp") / F.sum("support") * 100).alias("accuracy"),
        (F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1"),
    )


def binary_f1(df: DataFrame, truth: str, pred: str) -> DataFrame:
    t, p = F.col(truth) == 1, F.col(pred) == 1
    return df.agg(_ratio(F.count_if(t & p) * 2.0, F.count_if(t) + F.count_if(p)).alias("f1"))


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Area under the curve by mid-ranks; ``score`` may also be a hard label. Null with one class only."""
    counts = df.groupBy(score).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg")
    )
    ranked = running_sums(counts, [], [score], ["neg"])
    below = F.col("cum_neg") - F.col("neg") / 2
    return ranked.agg(
        F.try_divide(F.sum(F.col("pos") * below), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc")
    )


def regression_errors(df: DataFrame, real: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """MAE, MAPE, SMAPE (percent), MSLE and gamma deviance in one pass."""
    r, p = F.col(real), F.col(pred)
    both = F.abs(r) + F.abs(p)
    positive = (r > 0) & (p > 0)
    log_gap = F.ln(F.when(r > -1, 1 + r)) - F.ln(F.when(p > -1, 1 + p))
    deviance = F.when(positive, F.ln(p / r) + r / p - 1)
    return df.groupBy(*keys).agg(
        F.avg(F.abs(r - p)).alias("mae"),
        F.avg(F.try_divide(F.abs(r - p), F.greatest(F.abs(r), F.lit(2.220446049250313e-16)))).alias("mape"),
        (F.avg(F.coalesce(F.try_divide(2 * F.abs(r - p), both), F.lit(0.0))) * 100).alias("smape"),
        F.avg(log_gap * log_gap).alias("msle"),
        (F.avg(deviance) * 2).alias("gdev"),
    )


def aic(residual: Column, parameters: Column) -> Column:
    """n ln(SSE / n) + 2 k over the rows of a group."""
    n = F.count(residual)
    return n * F.ln(F.sum(residual * residual) / n) + parameters * 2


def binary_scores(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Accuracy (percent), F1 of class 1 and the area under the curve of the hard labels, in one row."""
    t, p = F.col(truth) == 1, F.col(pred) == 1
    counts = df.agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        (_ratio(tp + tn, tp + fp + fn + tn) * 100).alias("accuracy"),
        _ratio(tp * 2.0, tp * 2 + fp + fn).alias("f1"),
        ((F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2).alias("auc"),
    )
