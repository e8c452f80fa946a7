"""Per-series forecasters: planted coefficients, fitted weights, and no row lost."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import forecast as O


def arma(n, phi1, phi2, theta, seed, sigma=1.0):
    rng = np.random.default_rng(seed)
    e, r = rng.normal(0, sigma, n + 200), np.zeros(n + 200)
    for t in range(2, n + 200):
        r[t] = phi1 * r[t - 1] + phi2 * r[t - 2] + e[t] + theta * e[t - 1]
    return r[200:]


@pytest.mark.parametrize("planted", [(0.6, 0.2, 0.5), (1.1, -0.4, -0.6), (0.2, 0.1, 0.7)])
def test_planted_arma_is_recovered(planted):
    found, shock, sigma2 = O.fit_arma(arma(6000, *planted, seed=1, sigma=2.0))
    assert found == pytest.approx(planted, abs=0.08) and sigma2 == pytest.approx(4.0, rel=0.06)
    # Shocks of the right model look like noise.
    assert abs(np.corrcoef(shock[3:], shock[2:-1])[0, 1]) < 0.03


def test_interval_covers_four_of_five():
    hits, total, ar_misses, arma_misses = 0, 0, 0.0, 0.0
    for seed in range(60):
        t = np.arange(830)
        y = 10 + 4 * np.sin(2 * np.pi * t / 365.25) + arma(830, 0.5, 0.2, 0.6, seed)
        pred, lo, hi = O.harmonic_arma(y[:800], 30)
        hits += int(((y[800:] >= lo) & (y[800:] <= hi)).sum())
        total += 30
        arma_misses += abs(y[800] - pred[0])
        ar_misses += abs(y[800] - O.harmonic_ar(y[:800], 1)[0][0])
    assert hits / total == pytest.approx(0.8, abs=0.06)
    assert arma_misses < ar_misses * 1.02


def test_fitted_holt_never_loses_to_the_grid():
    rng = np.random.default_rng(5)
    for seed in range(12):
        y = np.cumsum(rng.normal(0.2, 1, 120)) + rng.normal(0, seed / 3, 120)
        a, b, loss = O.holt_weights(y)
        levels, trends = np.meshgrid(np.linspace(0.0, 1.0, 12), np.linspace(0.0, 1.0, 12))
        assert loss <= O.holt_paths(y, levels.ravel(), trends.ravel())[0].min() and 0 <= a <= 1 and 0 <= b <= 1
        assert loss == pytest.approx(O.holt_paths(y, np.array([a]), np.array([b]))[0][0])


def test_planted_holt_weights_are_recovered():
    rng = np.random.default_rng(6)
    level, trend, y = 10.0, 0.1, []
    for e in rng.normal(0, 1, 6000):
        y.append(level + trend + e)
        level, trend = level + trend + 0.6 * e, trend + 0.6 * 0.2 * e
    a, b, _ = O.holt_weights(np.array(y))
    assert a == pytest.approx(0.6, abs=0.05) and b == pytest.approx(0.2, abs=0.05)


def test_every_model_forecasts_every_row(spark):
    start = dt.date(2000, 1, 1)
    rows = [("long", start + dt.timedelta(days=i), float(i % 7)) for i in range(120)]
    rows += [("two", start + dt.timedelta(days=i), 5.0 + i) for i in (99, 100, 101, 102)] + [("late", start + dt.timedelta(days=i), 1.0) for i in (102, 103)]
    rows += [("gaps", start + dt.timedelta(days=i), None if i < 99 else 2.0) for i in range(90, 110)]
    df = spark.createDataFrame(rows, "series_id string, day date, value double")
    models = ["climatology", "seasonal_naive", "holt_trend_only", "harmonic_arma"]
    errors = O.backtest(df, models, "series_id", "day", "value", ["2000-04-10"], 10).persist()
    counts = {r["model"]: (r["n"], r["known"]) for r in errors.groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.count("err").alias("known")).collect()}
    assert set(counts) == set(models) and len({n for n, _ in counts.values()}) == 1
    two = {(r["model"], r["h"]): r["pred"] for r in errors.filter("series_id = 'two'").collect()}
    assert two["holt_trend_only", 1] == two["seasonal_naive", 1] == 105.0
    assert {r["pred"] for r in errors.filter("series_id = 'late'").collect()} == {None}
    common = O.common_rows(errors, "series_id").groupBy("model").agg(F.count("err").alias("n")).collect()
    assert len({r["n"] for r in common}) == 1 and not [r for r in O.common_rows(errors, "series_id").collect() if r["err"] is None]
