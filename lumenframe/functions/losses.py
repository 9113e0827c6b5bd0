"""Losses of a linear score: the value and the gradient as aggregate columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

CLIP = 1e-9


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def clipped_log(p: Column) -> Column:
    return F.ln(F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP)))


@dataclass(frozen=True)
class Loss:
    """``value(y, z)`` and ``gradient(y, z, x)`` aggregate over the rows; z is the linear score."""

    value: Callable[[Column, Column], Column]
    gradient: Callable[[Column, Column, Column], Column]


def _squared() -> Loss:
    return Loss(lambda y, z: F.avg((z - y) * (z - y)), lambda y, z, x: F.avg((z - y) * x) * 2)


def _cross_entropy() -> Loss:
    def value(y: Column, z: Column) -> Column:
        p = sigmoid(z)
        return -F.avg(y * clipped_log(p) + (1 - y) * clipped_log(1 - p))

    return Loss(value, lambda y, z, x: F.avg((sigmoid(z) - y) * x))


def _hinge() -> Loss:
    def gradient(y: Column, z: Column, x: Column) -> Column:
        return F.avg(F.when(y * z < 1, -y * x).otherwise(F.lit(0.0)))

    return Loss(lambda y, z: F.avg(F.greatest(1 - y * z, F.lit(0.0))), gradient)


def _hinge_of_mean() -> Loss:
    """max(0, mean(1 - y z)): one hinge over the whole sample; its gradient is a sum, not a mean."""

    def value(y: Column, z: Column) -> Column:
        return F.greatest(F.avg(1 - y * z), F.lit(0.0))

    def gradient(y: Column, z: Column, x: Column) -> Column:
        return F.when(value(y, z) > 0, F.sum(-y * x)).otherwise(F.lit(0.0))

    return Loss(value, gradient)


# squared and the hinges expect y = -1/+1, the cross entropy y = 0/1
LOSSES: dict[str, Loss] = {
    "squared": _squared(),
    "cross_entropy": _cross_entropy(),
    "hinge": _hinge(),
    "hinge_of_mean": _hinge_of_mean(),
}
