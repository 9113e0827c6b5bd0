"""Impurity of weighted class totals as columns."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9


def _total(parts: Sequence[Column]) -> Column:
    return functools.reduce(operator.add, parts)


def _shares(weights: Sequence[Column]) -> list[Column]:
    total = _total(weights)
    return [F.coalesce(F.try_divide(w, total), F.lit(0.0)) for w in weights]


def entropy(weights: Sequence[Column]) -> Column:
    return -_total([p * F.log2(p + EPS) for p in _shares(weights)])


def gini(weights: Sequence[Column]) -> Column:
    return 1 - _total([p * p for p in _shares(weights)])


def log_loss(weights: Sequence[Column]) -> Column:
    return -_total([p * F.ln(p + EPS) for p in _shares(weights)])


CRITERIA: dict[str, Callable[[Sequence[Column]], Column]] = {
    "entropy": entropy,
    "gini": gini,
    "log_loss": log_loss,
}


def gain(criterion: str, left: Sequence[Column], total: Sequence[Column]) -> Column:
    """Impurity of the whole minus the weighted impurity of the two sides."""
    f = CRITERIA[criterion]
    right = [t - lo for t, lo in zip(total, left, strict=True)]
    whole = _total(total)
    return f(total) - _total(left) / whole * f(left) - _total(right) / whole * f(right)
