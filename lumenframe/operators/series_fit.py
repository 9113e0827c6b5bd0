"""Tests, fits and forecasts per series.

Sums over the rows are Spark aggregates; only a d by d solve per series, or a recursion over one
bucketed series, runs in grouped Python.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.operators import series as S
from lumenframe.operators.joins import join_keys

# Response surface of the unit root test with a constant (one variable).
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def unit_root_p(stat: float) -> float:
    """Approximate p-value of the test statistic."""
    if stat > TAU_MAX:
        return 1.0
    if stat < TAU_MIN:
        return 0.0
    coef = SMALL_P if stat <= TAU_STAR else LARGE_P
    z = sum(c * stat**i for i, c in enumerate(coef))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _solve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    coef = np.linalg.lstsq(x, y, rcond=None)[0]
    return coef, y - x @ coef


def unit_root_test(y: np.ndarray) -> tuple[float, float, int]:
    """(statistic, p-value, lags): differences on the level, a constant and lagged differences.

    The number of lags is the one of least AIC up to 12 (n / 100)^(1/4), all compared on one sample.
    """
    n = len(y)
    top = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    if top < 0 or np.ptp(y) == 0:
        return math.nan, math.nan, 0
    dy = np.diff(y)

    def design(lags: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
        t = np.arange(skip, len(dy))
        cols = [y[t], *[dy[t - i] for i in range(1, lags + 1)], np.ones(len(t))]
        return np.column_stack(cols), dy[t]

    def score(lags: int) -> float:
        x, target = design(lags, top)
        _, r = _solve(x, target)
        return len(target) * math.log(max(float(r @ r), 1e-300) / len(target)) + 2 * x.shape[1]

    lags = min(range(top + 1), key=score)
    x, target = design(lags, lags)
    coef, r = _solve(x, target)
    free = len(target) - x.shape[1]
    if free <= 0:
        return math.nan, math.nan, lags
    var = float(r @ r) / free * np.linalg.pinv(x.T @ x)[0, 0]
    stat = float(coef[0] / math.sqrt(var)) if var > 0 else math.nan
    return stat, unit_root_p(stat) if not math.isnan(stat) else math.nan, lags


def transforms(df: DataFrame, keys: Sequence[str], time: str, y: str, season: int) -> DataFrame:
    """Long form ``keys, time, transform, y`` of six transforms, without the empty heads."""
    rows = df.select(*keys, time, F.col(y).alias("level"), F.ln(F.when(F.col(y) > 0, F.col(y))).alias("log"))
    for name in ("level", "log"):
        rows = S.difference(rows, keys, time, name, 1, f"{name}_diff")
        rows = S.difference(rows, keys, time, name, season, f"{name}_diff_season")
    names = [c for c in rows.columns if c not in (*keys, time)]
    return rows.unpivot([*keys, time], names, "transform", "y").filter("y IS NOT NULL")


def _grouped(df: DataFrame, keys: Sequence[str]):
    """Groups spread by a fixed number of partitions: small groups with a costly fit are not merged into one task."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys).groupBy(*keys)


def _key_fields(df: DataFrame, keys: Sequence[str]) -> list[T.StructField]:
    return [df.schema[k] for k in keys]


def stationarity(df: DataFrame, keys: Sequence[str], time: str, y: str, season: int) -> DataFrame:
    """``keys, transform, stat, p_value, lags, best``: the unit root test of each transform of each series."""
    long = transforms(df, keys, time, y, season)
    fields = [*_key_fields(long, keys), T.StructField("transform", T.StringType())]
    schema = T.StructType(
        [*fields, T.StructField("stat", T.DoubleType()), T.StructField("p_value", T.DoubleType()), T.StructField("lags", T.IntegerType())]
    )
    names = [f.name for f in fields]

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf.sort_values(time)["y"].to_numpy(dtype="float64")
        head = pdf.iloc[:1][names].reset_index(drop=True)
        return head.assign(**dict(zip(("stat", "p_value", "lags"), unit_root_test(values))))

    tested = _grouped(long, names).applyInPandas(test, schema)
    order = F.struct(F.coalesce(F.nanvl("p_value", F.lit(None).cast("double")), F.lit(2.0)), "transform")
    first = tested.groupBy(*keys).agg(F.min_by("transform", order).alias("_best"))
    return join_keys(tested, first, keys).select(*names, "stat", "p_value", "lags", (F.col("transform") == F.col("_best")).alias("best"))


def unit_root_lag0(df: DataFrame, keys: Sequence[str], time: str, y: str) -> DataFrame:
    """``keys, beta, t_stat``: the test without lagged differences, from sums alone."""
    rows = df.withColumn("_x", S.lagged(F.col(y), 1, keys, time)).withColumn("_d", F.col(y) - F.col("_x"))
    fit = rows.groupBy(*keys).agg(
        F.regr_slope("_d", "_x").alias("beta"), F.regr_sxx("_d", "_x").alias("sxx"), F.regr_syy("_d", "_x").alias("syy"),
        F.count("_d").alias("n"),
    )
    var = (F.col("syy") - F.col("beta") * F.col("beta") * F.col("sxx")) / (F.col("n") - 2) / F.col("sxx")
    return fit.select(*keys, "beta", F.try_divide(F.col("beta"), F.sqrt(var)).alias("t_stat"))


def lag_ridge(
    df: DataFrame, keys: Sequence[str], time: str, y: str, lags: Mapping[str, int], alpha: float
) -> DataFrame:
    """``keys`` and one coefficient per lag: least squares with penalty alpha per series, no constant.

    The normal equations are sums in one aggregation; each series is one row when it is solved.
    """
    terms = list(lags)
    d = len(terms)
    rows = S.lag_matrix(df, keys, time, y, dict(lags))
    xtx = F.array(*[F.sum(F.col(a) * F.col(b)) for a in terms for b in terms]).alias("xtx")
    xty = F.array(*[F.sum(F.col(a) * F.col(y)) for a in terms]).alias("xty")
    sums = rows.groupBy(*keys).agg(xtx, xty)
    schema = T.StructType([*_key_fields(df, keys), *[T.StructField(t, T.DoubleType()) for t in terms]])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                a = np.vstack(pdf["xtx"].to_numpy()).reshape(-1, d, d) + alpha * np.eye(d)
                b = np.linalg.solve(a, np.vstack(pdf["xty"].to_numpy())[:, :, None])[:, :, 0]
                yield pd.concat([pdf[list(keys)].reset_index(drop=True), pd.DataFrame(b, columns=terms)], axis=1)

    return sums.mapInPandas(solve, schema)


def in_sample(df: DataFrame, keys: Sequence[str], time: str, y: str, lags: Mapping[str, int], coef: DataFrame) -> DataFrame:
    """``keys, time, pred, resid``: dot product of the coefficients and the lag columns."""
    rows = S.lag_matrix(df, keys, time, y, dict(lags))
    named = coef.select(*keys, *[F.col(t).alias(f"_c_{t}") for t in lags])
    pred = sum((F.col(t) * F.col(f"_c_{t}") for t in lags), F.lit(0.0))
    return join_keys(rows, named, keys).select(*keys, time, pred.alias("pred"), (F.col(y) - pred).alias("resid"))


def _lagged(x: np.ndarray, lag: int) -> np.ndarray:
    return np.concatenate([np.zeros(min(lag, len(x))), x[: max(len(x) - lag, 0)]])


def long_ar_residuals(y: np.ndarray, order: int) -> np.ndarray:
    """Residuals of an autoregression long enough to stand in for the unseen shocks; zero at the head."""
    if len(y) <= 2 * order:
        return np.zeros(len(y))
    x = np.column_stack([_lagged(y, i) for i in range(1, order + 1)])[order:]
    _, r = _solve(x, y[order:])
    return np.concatenate([np.zeros(order), r])


def fit_arma(y: np.ndarray, ar: Sequence[int], ma: Sequence[int], ridge: float = 1e-6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two least-squares passes: (AR coefficients at lags ``ar``, MA at ``ma``, residuals)."""
    top = max([*ar, *ma, 1])
    shocks = long_ar_residuals(y, min(top + 5, len(y) // 4)) if ma else np.zeros(len(y))
    cols = [_lagged(y, i) for i in ar] + [_lagged(shocks, i) for i in ma]
    if not cols:
        return np.zeros(0), np.zeros(0), y.copy()
    x = np.column_stack(cols)
    coef = np.linalg.solve(x.T @ x + ridge * np.eye(x.shape[1]), x.T @ y)
    return coef[: len(ar)], coef[len(ar) :], y - x @ coef


def hannan_rissanen(
    df: DataFrame, keys: Sequence[str], time: str, y: str, p: int, q: int, seasonal: tuple[int, int, int] = (0, 0, 1)
) -> DataFrame:
    """``keys, term, coef, sse``: ARMA(p, q) of the centred series by two regressions.

    ``seasonal`` (P, Q, season) adds seasonal terms to both parts; a term is named by its lag.
    """
    sp, sq, season = seasonal
    ar_lags, ma_lags = _seasonal_lags(p, sp, season), _seasonal_lags(q, sq, season)
    schema = T.StructType(
        [*_key_fields(df, keys), T.StructField("term", T.StringType()), T.StructField("coef", T.DoubleType()), T.StructField("sse", T.DoubleType())]
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf.sort_values(time)[y].to_numpy(dtype="float64")
        ar, ma, r = fit_arma(v - v.mean(), ar_lags, ma_lags)
        names = [f"ar{i}" for i in ar_lags] + [f"ma{i}" for i in ma_lags]
        out = pd.DataFrame({"term": names, "coef": np.concatenate([ar, ma]), "sse": float(r @ r)})
        for k in reversed(list(keys)):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    return _grouped(df, keys).applyInPandas(fit, schema)


def _seasonal_lags(p: int, seasonal_p: int, season: int) -> list[int]:
    return sorted(S.lag_columns(p, seasonal_p, season).values())


def _differenced(v: np.ndarray, d: int, seasonal_d: int, season: int) -> np.ndarray:
    out = np.diff(v, n=d) if d else v
    for _ in range(seasonal_d):
        out = out[season:] - out[:-season]
    return out


def forecast_values(
    v: np.ndarray, order: tuple[int, int, int], seasonal: tuple[int, int, int, int], steps: int
) -> np.ndarray:
    """Difference, fit, forecast by recursion with future shocks at zero, integrate back."""
    (p, d, q), (sp, sd, sq, season) = order, seasonal
    levels = [v]
    for _ in range(d):
        levels.append(np.diff(levels[-1]))
    seasonal_levels = [levels[-1]]
    for _ in range(sd):
        seasonal_levels.append(seasonal_levels[-1][season:] - seasonal_levels[-1][:-season])
    w = seasonal_levels[-1]
    mean = w.mean()
    ar, ma = _seasonal_lags(p, sp, season), _seasonal_lags(q, sq, season)
    a, b, r = fit_arma(w - mean, ar, ma)
    x, e = list(w - mean), list(r)
    for _ in range(steps):
        value = sum(c * x[-i] for c, i in zip(a, ar) if i <= len(x)) + sum(c * e[-i] for c, i in zip(b, ma) if i <= len(e))
        x.append(value)
        e.append(0.0)
    future = np.array(x[len(w) :]) + mean
    for level in reversed(seasonal_levels[:-1]):
        ext = list(level)
        for step in future:
            ext.append(step + ext[-season])
        future = np.array(ext[len(level) :])
    for level in reversed(levels[:-1]):
        future = level[-1] + np.cumsum(future)
    return future


def forecast(
    df: DataFrame, keys: Sequence[str], time: str, y: str, order: tuple[int, int, int], seasonal: tuple[int, int, int, int], steps: int
) -> DataFrame:
    """``keys, h, y_hat`` per series."""
    schema = T.StructType([*_key_fields(df, keys), T.StructField("h", T.IntegerType()), T.StructField("y_hat", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf.sort_values(time)[y].to_numpy(dtype="float64")
        out = pd.DataFrame({"h": np.arange(1, steps + 1, dtype="int32"), "y_hat": forecast_values(v, order, seasonal, steps)})
        for k in reversed(list(keys)):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    return _grouped(df, keys).applyInPandas(run, schema)


def order_search(
    df: DataFrame, keys: Sequence[str], time: str, y: str, grid: Sequence[tuple[int, int, int, int]], d: int, seasonal_d: int, season: int
) -> DataFrame:
    """``keys, p, q, sp, sq, aic, best``: every order of the grid fitted to every series, one task each.

    An order that cannot be fitted has a null AIC and is never the best.
    """
    orders = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(o, ("p", "q", "sp", "sq"))]) for o in grid])
    pairs = df.select(*keys, time, F.col(y).alias("_y"), F.explode(orders).alias("_o")).select(*keys, time, "_y", "_o.*")
    names = ["p", "q", "sp", "sq"]
    schema = T.StructType(
        [*_key_fields(df, keys), *[T.StructField(n, T.IntegerType()) for n in names], T.StructField("aic", T.DoubleType())]
    )

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q, sp, sq = (int(pdf[n].iloc[0]) for n in names)
        v = pdf.sort_values(time)["_y"].to_numpy(dtype="float64")
        try:
            w = _differenced(v, d, seasonal_d, season)
            ar, ma = _seasonal_lags(p, sp, season), _seasonal_lags(q, sq, season)
            _, _, r = fit_arma(w - w.mean(), ar, ma)
            value = len(r) * math.log(float(r @ r) / len(r)) + 2 * (len(ar) + len(ma))
        except (ValueError, np.linalg.LinAlgError, ZeroDivisionError):
            value = math.nan
        return pdf.iloc[:1][[*keys, *names]].reset_index(drop=True).assign(aic=value)

    fitted = _grouped(pairs, [*keys, *names]).applyInPandas(fit, schema)
    fitted = fitted.withColumn("aic", F.nanvl("aic", F.lit(None).cast("double")))
    chosen = fitted.filter("aic IS NOT NULL").groupBy(*keys).agg(
        F.min_by(F.struct(*names), F.struct("aic", *names)).alias("_b")
    )
    return join_keys(fitted, chosen, keys, "left").select(
        *keys, *names, "aic", (F.struct(*names) == F.col("_b")).alias("best")
    )
