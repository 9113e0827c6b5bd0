"""Parameter grids and searches on one holdout."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.operators.metrics import holdout_scores


def grid_rows(space: Mapping[str, Iterable]) -> list[dict]:
    return [dict(zip(space, values)) for values in itertools.product(*space.values())]


def with_grid(df: DataFrame, space: Mapping[str, Iterable]) -> DataFrame:
    """Every row with every parameter set: nested explodes of literal arrays, no join."""
    out = df
    for name, values in space.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out


@dataclass(frozen=True)
class IntRange:
    low: int
    high: int

    def draw(self, rng: random.Random) -> int:
        return rng.randint(self.low, self.high)


@dataclass(frozen=True)
class FloatRange:
    low: float
    high: float

    def draw(self, rng: random.Random) -> float:
        return rng.uniform(self.low, self.high)


@dataclass(frozen=True)
class Choice:
    values: tuple

    def draw(self, rng: random.Random):
        return rng.choice(self.values)


def draws(space: Mapping[str, IntRange | FloatRange | Choice], trials: int = 100, seed: int = 42) -> list[dict]:
    """``trials`` seeded random parameter sets."""
    rng = random.Random(seed)
    return [{name: kind.draw(rng) for name, kind in space.items()} for _ in range(trials)]


def run_trials(
    train: DataFrame,
    test: DataFrame,
    build: Callable[[dict], Estimator],
    trials: Sequence[dict],
    metric: Callable[[DataFrame, str, str], DataFrame] = holdout_scores,
    parallelism: int = 4,
) -> list[tuple[dict, float, float]]:
    """(parameters, accuracy, score) per parameter set on one holdout; fits are parallel Spark jobs.

    The rows of both parts are kept while the trials last, in memory as far as it goes, so that no trial scans and splits them again.
    ``metric(df, truth, pred)`` gives one row; its last column is the score to maximise.
    """

    def run(params: dict) -> tuple[dict, float, float]:
        scored = build(params).fit(train).transform(test)
        hits = F.avg(F.when(F.col("label") == F.col("prediction"), 100.0).otherwise(0.0))
        accuracy = scored.agg(hits).first()[0] if metric is not holdout_scores else None
        row = metric(scored, "label", "prediction").first()
        return params, row["accuracy"] if accuracy is None else accuracy, row[-1]

    kept = [df.persist() for df in (train, test) if not (df.storageLevel.useMemory or df.storageLevel.useDisk)]
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            return list(pool.map(inheritable_thread_target(train.sparkSession)(run), trials))
    finally:
        for df in kept:
            df.unpersist()


def best_trial(results: Sequence[tuple[dict, float, float]]) -> int:
    """Index of the greatest score; the first wins ties."""
    return max(range(len(results)), key=lambda i: (round(results[i][2], 12), -i))
