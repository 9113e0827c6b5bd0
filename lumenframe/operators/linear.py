"""Linear models from sums over the rows: least squares, ridge, gradient descent."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenframe.functions.losses import LOSSES
from lumenframe.sources.tables import right_sized

MAX_TERMS = 200
INTERCEPT = "intercept"


@dataclass(frozen=True)
class NormalSums:
    """X'X, X'y, y'y, sum of y and row count of a design with named terms; ``mean`` and ``centred`` are about the means."""

    terms: tuple[str, ...]
    xtx: np.ndarray
    xty: np.ndarray
    yty: float
    y_sum: float
    n: int
    mean: np.ndarray
    centred: np.ndarray


def normal_sums(df: DataFrame, features: Sequence[str], target: str, intercept: bool) -> NormalSums:
    """Two aggregations: the means, then the products of the differences from them, which don't cancel when means are large.

    The driver sees a row of at most MAX_TERMS squared numbers. Rows with nulls are left out.
    """
    terms = ([INTERCEPT] if intercept else []) + list(features)
    if len(terms) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms: use the iterative estimators")
    rows = df.na.drop(subset=[*features, target])
    every = [F.col(c).cast("double") for c in (*features, target)]
    d = len(every)
    row = rows.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(every)], F.count(F.lit(1))).first()
    mean, n = np.array([v or 0.0 for v in row[:d]]), row[-1]
    off = [c - F.lit(float(m)) for c, m in zip(every, mean)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.agg(*[F.sum(off[i] * off[j]).alias(f"s{k}") for k, (i, j) in enumerate(pairs)]).first()
    centred = np.zeros((d, d))
    for (i, j), v in zip(pairs, sums):
        centred[i, j] = centred[j, i] = v or 0.0
    raw = centred + n * np.outer(mean, mean)
    if intercept:
        raw = np.block([[np.array([[float(n)]]), n * mean[None, :]], [n * mean[:, None], raw]])
    return NormalSums(tuple(terms), raw[:-1, :-1], raw[:-1, -1], float(raw[-1, -1]), float(n * mean[-1]), n, mean, centred)


def least_squares(df: DataFrame, features: Sequence[str], target: str, intercept: bool = True) -> DataFrame:
    """``term, coef, se, t, r2``; without a constant r2 is the uncentred one."""
    s = normal_sums(df, features, target, intercept)
    if intercept:
        slope = np.linalg.pinv(s.centred[:-1, :-1])
        b, x = slope @ s.centred[:-1, -1], s.mean[:-1]
        first = np.array([[(1 / s.n if s.n else 0.0) + x @ slope @ x]])
        inverse = np.block([[first, -(slope @ x)[None, :]], [-(slope @ x)[:, None], slope]])
        coef = np.concatenate([[s.mean[-1] - b @ x], b])
        sse, total = max(float(s.centred[-1, -1] - b @ s.centred[:-1, -1]), 0.0), float(s.centred[-1, -1])
    else:
        inverse = np.linalg.pinv(s.xtx)
        coef = inverse @ s.xty
        sse, total = max(float(s.yty - coef @ s.xty), 0.0), s.yty
    free = s.n - len(s.terms)
    se = np.sqrt(np.diag(inverse) * sse / free) if free > 0 else np.full(len(coef), np.nan)
    r2 = float(1 - sse / total) if total else None
    rows = [
        (t, float(c), float(e), float(c / e) if e else None, r2) for t, c, e in zip(s.terms, coef, se, strict=True)
    ]
    return df.sparkSession.createDataFrame(rows, "term string, coef double, se double, t double, r2 double")


def ridge(
    df: DataFrame, features: Sequence[str], target: str, alpha: float, penalize_intercept: bool = True
) -> dict[str, float]:
    """Coefficients of (X'X + alpha I) b = X'y, the intercept penalised too unless told otherwise."""
    s = normal_sums(df, features, target, True)
    penalty = np.full(len(s.terms), float(alpha))
    if not penalize_intercept:
        penalty[0] = 0.0
    coef = np.linalg.solve(s.xtx + np.diag(penalty), s.xty)
    return {t: float(c) for t, c in zip(s.terms, coef, strict=True)}


def coefficient_table(df: DataFrame, coef: dict[str, float]) -> DataFrame:
    return df.sparkSession.createDataFrame(list(coef.items()), "term string, coef double")


def linear_score(coef: dict[str, float], transform: Callable[[Column], Column] | None = None) -> Column:
    """Linear score of a row; ``transform`` turns it into a prediction, such as a class."""
    score = F.lit(coef.get(INTERCEPT, 0.0))
    for term, c in coef.items():
        if term != INTERCEPT:
            score = score + F.col(term) * F.lit(c)
    return transform(score) if transform else score


def gradient_descent(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    loss: str,
    rate: float,
    steps: int,
    l1: float = 0.0,
    l2: float = 0.0,
    curve_of: Callable[[Column, Column], Column] | None = None,
) -> tuple[dict[str, float], list[float]]:
    """Weights after ``steps`` full-gradient steps from zero, and the learning curve before each step.

    The curve is the loss, or ``curve_of(label, score)``, an aggregate column of the caller. Each step is one
    aggregation with map-side combine; only the weight vector travels.
    """
    if len(features) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms: use the iterative estimators")
    fn = LOSSES[loss]
    weights = dict.fromkeys(features, 0.0)
    curve: list[float] = []
    y = F.col(target).cast("double")
    cached = df.select(*features, target).persist()
    data = right_sized(cached)
    for _ in range(steps):
        z = linear_score(weights)
        row = data.agg((curve_of or fn.value)(y, z), *[fn.gradient(y, z, F.col(f)) for f in features]).first()
        if row[0] is None:
            break
        curve.append(row[0])
        weights = {
            f: w - rate * (g + l2 * w + l1 * float(np.sign(w))) for (f, w), g in zip(weights.items(), row[1:])
        }
    cached.unpersist()
    return weights, curve
