"""Baseline and per-series forecasters, rolling-origin backtests and their summaries.

Input is a gap-free daily series per id.  A forecaster returns rows
``model, series_id, origin, h, day, actual, pred, lo, hi``; intervals are NULL
where the model has none.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Z80 = 1.2815515655446004


def origin_dates(start: str, end: str, n: int) -> list[str]:
    """n dates evenly spaced from start to end, whole days."""
    a, z = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return [str(a + dt.timedelta(days=(z - a).days * i // (n - 1))) for i in range(n)] if n > 1 else [start]


def _origin_array(origins: list[str]) -> Column:
    return F.array(*[F.lit(o).cast("date") for o in origins])


def training_rows(df: DataFrame, day: str, origins: list[str]) -> DataFrame:
    """One copy of each row per origin at or after it; origins are a short fixed list."""
    return df.select("*", F.explode(F.filter(_origin_array(origins), lambda o: o >= F.col(day))).alias("origin"))


def target_rows(df: DataFrame, series: str, day: str, value: str, origins: list[str], horizon: int) -> DataFrame:
    within = F.filter(_origin_array(origins), lambda o: (o < F.col(day)) & (F.date_diff(F.col(day), o) <= horizon))
    rows = df.filter(F.col(value).isNotNull()).select(
        series, day, F.col(value).alias("actual"), F.explode(within).alias("origin")
    )
    return rows.withColumn("h", F.date_diff(day, "origin"))


def _shape(df: DataFrame, model: str, series: str, day: str, pred: Column) -> DataFrame:
    none = F.lit(None).cast("double")
    return df.select(F.lit(model).alias("model"), series, "origin", "h", day, "actual", pred.alias("pred"),
                     none.alias("lo"), none.alias("hi"))


def climatology(df: DataFrame, series: str, day: str, value: str, origins: list[str], horizon: int) -> DataFrame:
    """Mean of the same day of year over the training part, else the training mean."""
    train = training_rows(df, day, origins).withColumn("doy", F.dayofyear(day))
    by_day = train.groupBy(series, "origin", "doy").agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    overall = by_day.groupBy(series, "origin").agg((F.sum("_s") / F.sum("_n")).alias("_all"))
    target = target_rows(df, series, day, value, origins, horizon).withColumn("doy", F.dayofyear(day))
    joined = target.join(by_day, [series, "origin", "doy"], "left").join(overall, [series, "origin"], "left")
    return _shape(joined, "climatology", series, day, F.coalesce(F.try_divide(F.col("_s"), F.col("_n")), F.col("_all")))


def seasonal_naive(df: DataFrame, series: str, day: str, value: str, origins: list[str], horizon: int,
                   season: int = 365) -> DataFrame:
    """Value one season earlier if it lies in the training part, else the last training value."""
    target = target_rows(df, series, day, value, origins, horizon)
    past = df.select(series, F.date_add(day, season).alias(day), F.col(value).alias("_past"), F.col(day).alias("_pday"))
    last = training_rows(df, day, origins).groupBy(series, "origin").agg(F.max_by(value, day).alias("_last"))
    joined = target.join(past, [series, day], "left").join(last, [series, "origin"], "left")
    usable = F.when(F.col("_pday") <= F.col("origin"), F.col("_past"))
    return _shape(joined, "seasonal_naive", series, day, F.coalesce(usable, F.col("_last")))


# A per-series forecaster: (training values, steps) -> (prediction, low, high), the last two possibly None.
Forecaster = Callable[[np.ndarray, int], tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]


def holt_paths(y: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Squared one-step misses, last level and last trend for many pairs of weights, advanced together."""
    level = np.full(a.shape, y[0])
    trend = np.full(a.shape, y[1] - y[0] if len(y) > 1 else 0.0)
    sse = np.zeros(a.shape)
    for value in y[1:]:
        ahead = level + trend
        miss = value - ahead
        sse += miss * miss
        level = ahead + a * miss
        trend = trend + a * b * miss
    return sse, level, trend


def holt_weights(y: np.ndarray, grid: int = 12, precision: float = 1e-4) -> tuple[float, float, float]:
    """Weights in [0, 1] x [0, 1] with the least squared misses: the best of a grid, then a pattern search around it.

    Every round tries the eight neighbours at the present step at once, moves to the best if it is better, and
    halves the step otherwise; so the loss is never above the grid's.
    """
    levels, trends = np.meshgrid(np.linspace(0.0, 1.0, grid), np.linspace(0.0, 1.0, grid))
    sse, _, _ = holt_paths(y, levels.ravel(), trends.ravel())
    at = int(np.argmin(sse))
    best, a, b, step = float(sse[at]), float(levels.ravel()[at]), float(trends.ravel()[at]), 1.0 / (grid - 1)
    moves = np.array([(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j], dtype=float)
    while step >= precision:
        tried = np.clip(np.array([a, b]) + step * moves, 0.0, 1.0)
        sse, _, _ = holt_paths(y, tried[:, 0], tried[:, 1])
        at = int(np.argmin(sse))
        if sse[at] < best:
            best, a, b = float(sse[at]), float(tried[at, 0]), float(tried[at, 1])
        else:
            step /= 2
    return a, b, best


def holt_linear(y: np.ndarray, steps: int):
    """Linear trend smoothing with both weights fitted to the one-step misses."""
    a, b, _ = holt_weights(y)
    _, level, trend = holt_paths(y, np.array([a]), np.array([b]))
    return level[0] + trend[0] * np.arange(1, steps + 1), None, None


def _harmonics(t: np.ndarray, k_max: int, period: float) -> np.ndarray:
    cols = [np.ones(len(t))]
    for k in range(1, k_max + 1):
        cols += [np.sin(2 * np.pi * k * t / period), np.cos(2 * np.pi * k * t / period)]
    return np.column_stack(cols)


def harmonic_ar(y: np.ndarray, steps: int, k_max: int = 3, period: float = 365.25, z: float = Z80):
    """Harmonic least squares, then an AR(2) on its residuals; intervals from the AR's growing variance."""
    n = len(y)
    design = _harmonics(np.arange(n), k_max, period)
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    resid = y - design @ beta
    if n > 10:
        past = np.column_stack([resid[1:-1], resid[:-2]])
        phi, *_ = np.linalg.lstsq(past, resid[2:], rcond=None)
        noise = resid[2:] - past @ phi
        sigma2 = float(noise @ noise) / max(1, len(noise) - 2)
    else:
        phi, sigma2 = np.zeros(2), float(resid.var())
    r1, r2 = resid[-1], resid[-2] if n > 1 else 0.0
    psi1, psi2 = 1.0, 0.0
    pred, spread, total = np.empty(steps), np.empty(steps), 0.0
    seasonal = _harmonics(np.arange(n, n + steps), k_max, period) @ beta
    for h in range(steps):
        r1, r2 = phi[0] * r1 + phi[1] * r2, r1
        pred[h] = seasonal[h] + r1
        total += psi1 * psi1
        spread[h] = z * math.sqrt(sigma2 * total)
        psi1, psi2 = phi[0] * psi1 + phi[1] * psi2, psi1
    return pred, pred - spread, pred + spread


def arma_shocks(r: np.ndarray, phi1: float, phi2: float, theta: float) -> tuple[np.ndarray, np.ndarray]:
    """Shocks of an ARMA(2, 1) given its first two values, and their derivatives by the three coefficients."""
    n = len(r)
    shock, slope = np.zeros(n), np.zeros((n, 3))
    plain = r[2:] - phi1 * r[1:-1] - phi2 * r[:-2]
    for t in range(2, n):
        shock[t] = plain[t - 2] - theta * shock[t - 1]
        slope[t, 0] = -r[t - 1] - theta * slope[t - 1, 0]
        slope[t, 1] = -r[t - 2] - theta * slope[t - 1, 1]
        slope[t, 2] = -shock[t - 1] - theta * slope[t - 1, 2]
    return shock, slope


def settled(phi1: float, phi2: float, theta: float) -> bool:
    """Stationary and invertible."""
    return abs(phi2) < 0.999 and phi1 + phi2 < 0.999 and phi2 - phi1 < 0.999 and abs(theta) < 0.999


def fit_arma(r: np.ndarray, rounds: int = 20) -> tuple[np.ndarray, np.ndarray, float]:
    """(phi1, phi2, theta), shocks, shock variance of an ARMA(2, 1).

    Two steps for a start: a long autoregression gives shocks, a regression on two values and one shock gives coefficients.
    Then Gauss-Newton steps on the sum of squared shocks, halved until it falls and the model is stationary and invertible.
    """
    n = len(r)
    long = min(max(4, int(10 * math.log10(n))), n // 4)
    past = np.column_stack([r[long - i - 1 : n - i - 1] for i in range(long)])
    weights, *_ = np.linalg.lstsq(past, r[long:], rcond=None)
    rough = np.concatenate([np.zeros(long), r[long:] - past @ weights])
    at = np.arange(long + 2, n)
    start, *_ = np.linalg.lstsq(np.column_stack([r[at - 1], r[at - 2], rough[at - 1]]), r[at], rcond=None)
    w = start if settled(*start) else np.zeros(3)
    shock, slope = arma_shocks(r, *w)
    loss = float(shock @ shock)
    for _ in range(rounds):
        move, *_ = np.linalg.lstsq(slope[2:], -shock[2:], rcond=None)
        share, better = 1.0, None
        while share > 1e-4 and better is None:
            tried = w + share * move
            if settled(*tried):
                found = arma_shocks(r, *tried)
                if float(found[0] @ found[0]) < loss:
                    better = (tried, *found)
            share /= 2
        if better is None:
            break
        gain = loss - float(better[1] @ better[1])
        w, shock, slope = better
        loss -= gain
        if gain <= 1e-10 * max(loss, 1e-300):
            break
    return w, shock, loss / max(1, n - 5)


def harmonic_arma(y: np.ndarray, steps: int, k_max: int = 3, period: float = 365.25, z: float = Z80):
    """Harmonic least squares with ARMA(2, 1) errors; intervals from the growing variance of the errors' forecast.

    Series too short for the errors' model (under 40 values) have independent errors.
    """
    n = len(y)
    design = _harmonics(np.arange(n), k_max, period)
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    resid = y - design @ beta
    if n >= 40:
        (phi1, phi2, theta), shock, sigma2 = fit_arma(resid)
    else:
        phi1 = phi2 = theta = 0.0
        shock, sigma2 = resid, float(resid.var())
    r1, r2, last = resid[-1], resid[-2] if n > 1 else 0.0, shock[-1]
    psi1, psi2 = 1.0, 0.0
    pred, spread, total = np.empty(steps), np.empty(steps), 0.0
    seasonal = _harmonics(np.arange(n, n + steps), k_max, period) @ beta
    for h in range(steps):
        # The last shock is known for one step; later ones are expected to be 0.
        r1, r2 = phi1 * r1 + phi2 * r2 + (theta * last if h == 0 else 0.0), r1
        pred[h] = seasonal[h] + r1
        total += psi1 * psi1
        spread[h] = z * math.sqrt(sigma2 * total)
        psi1, psi2 = phi1 * psi1 + phi2 * psi2 + (theta if h == 0 else 0.0), psi1
    return pred, pred - spread, pred + spread


FORECASTERS: dict[str, Forecaster] = {"holt_trend_only": holt_linear, "harmonic_ar": harmonic_ar, "harmonic_arma": harmonic_arma}


def per_series(df: DataFrame, model: str, fn: Forecaster, series: str, day: str, value: str, origins: list[str],
               horizon: int) -> DataFrame:
    """Run any forecaster on every (series, origin) pair in parallel.

    Each task gets the training part of one series, bounded by the calendar,
    plus the horizon's actual values, which the forecaster never sees.  Every row that a baseline
    forecasts is here as well: with one or two training values the last one is the forecast, with none it is NULL.
    """
    near = F.filter(_origin_array(origins), lambda o: F.date_diff(F.col(day), o) <= horizon)
    rows = df.filter(F.col(value).isNotNull()).select(series, day, F.col(value).cast("double").alias(value), F.explode(near).alias("origin"))
    rows = rows.withColumnsRenamed({day: "day", value: "value"})
    kind = df.schema[series].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("day")
        origin = pdf["origin"].iloc[0]
        is_train = pdf["day"] <= origin
        train, test = pdf[is_train], pdf[~is_train]
        if test.empty:
            return pd.DataFrame(columns=["model", series, "origin", "h", "day", "actual", "pred", "lo", "hi"])
        h = np.array([(d - origin).days for d in test["day"]])
        if len(train) < 3:
            pred, lo, hi = np.full(int(h.max()), train["value"].iloc[-1] if len(train) else np.nan), None, None
        else:
            pred, lo, hi = fn(train["value"].to_numpy(float), int(h.max()))
        nothing = np.full(len(h), np.nan)
        return pd.DataFrame({
            "model": model, series: test[series].to_numpy(), "origin": origin, "h": h, "day": test["day"].to_numpy(),
            "actual": test["value"].to_numpy(), "pred": pred[h - 1],
            "lo": nothing if lo is None else lo[h - 1], "hi": nothing if hi is None else hi[h - 1],
        })

    schema = f"model string, {series} {kind}, origin date, h int, day date, actual double, pred double, lo double, hi double"
    out = rows.groupBy(series, "origin").applyInPandas(run, schema)
    none = F.lit(None).cast("double")
    return out.select("model", series, "origin", "h", F.col("day").alias(day), "actual", F.nanvl("pred", none).alias("pred"),
                      F.nanvl("lo", F.lit(None).cast("double")).alias("lo"), F.nanvl("hi", F.lit(None).cast("double")).alias("hi"))


BASELINES = {"climatology": climatology, "seasonal_naive": seasonal_naive}


def run_model(name: str, df: DataFrame, series: str, day: str, value: str, origins: list[str], horizon: int) -> DataFrame:
    """Forecast with the named model, baseline or per-series."""
    if name in BASELINES:
        return BASELINES[name](df, series, day, value, origins, horizon)
    return per_series(df, name, FORECASTERS[name], series, day, value, origins, horizon)


def backtest(df: DataFrame, models: list[str], series: str, day: str, value: str, origins: list[str], horizon: int = 30) -> DataFrame:
    out = None
    for name in models:
        part = run_model(name, df, series, day, value, origins, horizon)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("err", F.col("actual") - F.col("pred"))


def common_rows(errors: DataFrame, series: str) -> DataFrame:
    """Rows that every model in ``errors`` has a forecast for, so that models are compared over the same ones."""
    models = errors.select("model").distinct().agg(F.count(F.lit(1)).alias("_models"))
    have = errors.filter("err is not null").groupBy(series, "origin", "h").agg(F.count_distinct("model").alias("_have"))
    whole = have.join(F.broadcast(models)).filter("_have = _models").drop("_have", "_models")
    return errors.join(whole, [series, "origin", "h"], "left_semi")


def summary(errors: DataFrame) -> DataFrame:
    e = F.col("err")
    return errors.groupBy("model").agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.count(e).alias("n"))


def by_horizon(errors: DataFrame, models: list[str]) -> DataFrame:
    """Mean absolute error per horizon, one column per model."""
    return errors.groupBy("h").pivot("model", models).agg(F.avg(F.abs("err")))


def champion(summed: DataFrame) -> DataFrame:
    """The model with the lowest mean absolute error; ties go to the first name."""
    return summed.agg(F.min(F.struct("mae", "model")).alias("b")).select("b.model", "b.mae")


def interval_coverage(errors: DataFrame) -> DataFrame:
    inside = F.col("actual").between(F.col("lo"), F.col("hi"))
    return errors.filter(F.col("lo").isNotNull()).groupBy("model").agg(
        F.avg(inside.cast("double")).alias("coverage"), F.count(F.lit(1)).alias("n")
    )


def holdout(df: DataFrame, model: str, series: str, day: str, value: str, cut: str, horizon: int = 365,
            baseline: str = "seasonal_naive") -> DataFrame:
    """Model against baseline on the time after the cut, with interval coverage where the model has intervals."""
    scored = backtest(df, [model, baseline], series, day, value, [cut], horizon)
    a = F.abs("err")
    inside = F.col("actual").between(F.col("lo"), F.col("hi")).cast("double")
    return scored.groupBy(series).agg(
        F.avg(F.when(F.col("model") == model, a)).alias("mae"), F.avg(F.when(F.col("model") == baseline, a)).alias("baseline_mae"),
        F.avg(F.when(F.col("lo").isNotNull(), inside)).alias("coverage"), F.count_if(F.col("model") == model).alias("n"),
    )
