"""Forecast baselines, per-series models, rolling-origin backtests on the daily values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as O
from ..session import materialised
from .registry import query
from .series import DAILY, filled_days, rnd

c = F.col
ORIGINS = O.origin_dates("2000-06-30", "2001-06-15", 6)
HORIZON = 30
CUT = "2000-07-31"
MODELS = ["climatology", "seasonal_naive", "holt_trend_only", "harmonic_arma"]
KEYS = ("series_id", "day", "value")


def _baseline_sql(origins: list[str], horizon: int) -> str:
    listed = ", ".join(f"DATE '{o}'" for o in origins)
    return DAILY + f""",
origins AS (SELECT unnest([{listed}]) AS origin),
train AS (SELECT * FROM filled, origins WHERE day <= origin),
target AS (SELECT series_id, origin, day, datediff('day', origin, day) AS h, value AS actual FROM filled, origins WHERE day > origin AND datediff('day', origin, day) <= {horizon}),
doy AS (SELECT series_id, origin, dayofyear(day) AS d, avg(value) AS v FROM train GROUP BY 1, 2, 3),
allm AS (SELECT series_id, origin, avg(value) AS v, arg_max(value, day) AS lastv FROM train GROUP BY 1, 2),
fc AS (
  SELECT 'climatology' AS model, t.*, COALESCE(doy.v, allm.v) AS pred FROM target t LEFT JOIN doy ON t.series_id = doy.series_id AND t.origin = doy.origin AND dayofyear(t.day) = d
    JOIN allm ON t.series_id = allm.series_id AND t.origin = allm.origin
  UNION ALL
  SELECT 'seasonal_naive', t.*, COALESCE(p.value, allm.lastv) FROM target t LEFT JOIN filled p ON p.series_id = t.series_id AND p.day = t.day - 365 AND p.day <= t.origin
    JOIN allm ON t.series_id = allm.series_id AND t.origin = allm.origin),
err AS (SELECT *, actual - pred AS err FROM fc)
"""


BASE = _baseline_sql(ORIGINS, HORIZON)
SHOWN = "series_id, CAST(origin AS VARCHAR) AS origin, CAST(h AS INTEGER) AS h, CAST(day AS VARCHAR) AS day, actual, round(pred + 1e-7, 3) AS pred"


#: Interpolated values often end in an exact half, which two engines round differently; this takes them off it.
OFF_HALF = 1e-7


def _shown(df):
    return df.select("series_id", "origin", "h", "day", "actual", F.round(c("pred") + OFF_HALF, 3).alias("pred"))


def days(t):
    """The gap-free daily series, written once because every model and origin reads it again."""
    return materialised(filled_days(t).select(*KEYS))


@query("fc_climatology", f"WITH {BASE} SELECT {SHOWN} FROM err WHERE model = 'climatology'")
def fc_climatology(t):
    return _shown(O.climatology(days(t), *KEYS, ORIGINS, HORIZON))


@query("fc_seasonal_naive", f"""WITH {BASE} SELECT series_id, CAST(origin AS VARCHAR) AS origin, CAST(h AS INTEGER) AS h, CAST(day AS VARCHAR) AS day, actual, pred
FROM err WHERE model = 'seasonal_naive'""")
def fc_seasonal_naive(t):
    out = O.seasonal_naive(days(t), *KEYS, ORIGINS, HORIZON)
    return out.select("series_id", "origin", "h", "day", "actual", "pred")


@query("fc_holt")
def fc_holt(t):
    return _shown(O.run_model("holt_trend_only", days(t), *KEYS, ORIGINS, HORIZON))


@query("fc_harmonic_ar")
def fc_harmonic_ar(t):
    return O.run_model("harmonic_ar", days(t), *KEYS, ORIGINS, HORIZON)


@query("fc_harmonic_arma")
def fc_harmonic_arma(t):
    return O.run_model("harmonic_arma", days(t), *KEYS, ORIGINS, HORIZON)


def all_errors(t):
    """All four models over six origins and thirty days, on the rows that each of them forecasts."""
    return O.common_rows(materialised(O.backtest(days(t), MODELS, *KEYS, ORIGINS, HORIZON)), "series_id")


@query("backtest_errors")
def backtest_errors(t):
    return all_errors(t).select("model", "series_id", "origin", "h", "err")


@query("backtest_baselines", f"WITH {BASE} SELECT model, series_id, CAST(origin AS VARCHAR) AS origin, CAST(h AS INTEGER) AS h, round(err + 1e-7, 3) AS err FROM err")
def backtest_baselines(t):
    errors = O.backtest(days(t), MODELS[:2], *KEYS, ORIGINS, HORIZON)
    return errors.select("model", "series_id", "origin", "h", F.round(c("err") + OFF_HALF, 3).alias("err"))


@query("backtest_summary", f"WITH {BASE} SELECT model, round(avg(abs(err)), 3) AS mae, round(sqrt(avg(err * err)), 3) AS rmse, count(*) AS n FROM err GROUP BY 1")
def backtest_summary(t):
    return rnd(O.summary(O.backtest(days(t), MODELS[:2], *KEYS, ORIGINS, HORIZON)), 3)


@query("backtest_by_h", f"""WITH {BASE} SELECT CAST(h AS INTEGER) AS h, round(avg(abs(err)) FILTER (WHERE model = 'climatology'), 3) AS climatology,
 round(avg(abs(err)) FILTER (WHERE model = 'seasonal_naive'), 3) AS seasonal_naive FROM err GROUP BY 1""")
def backtest_by_h(t):
    return rnd(O.by_horizon(O.backtest(days(t), MODELS[:2], *KEYS, ORIGINS, HORIZON), MODELS[:2]), 3)


@query("champion", f"WITH {BASE} SELECT model, round(avg(abs(err)), 3) AS mae FROM err GROUP BY 1 ORDER BY avg(abs(err)), model LIMIT 1")
def champion(t):
    return rnd(O.champion(O.summary(O.backtest(days(t), MODELS[:2], *KEYS, ORIGINS, HORIZON))), 3)


@query("backtest_all_models")
def backtest_all_models(t):
    return O.summary(all_errors(t)).orderBy("mae")


@query("backtest_by_h_all_models")
def backtest_by_h_all_models(t):
    """Mean absolute error per horizon, the four models as columns."""
    return O.by_horizon(all_errors(t), MODELS)


@query("champion_all_models")
def champion_all_models(t):
    return O.champion(O.summary(all_errors(t)))


@query("holdout_eval", f"""WITH {_baseline_sql([CUT], 365)} SELECT series_id, round(avg(abs(err)) FILTER (WHERE model = 'climatology'), 3) AS mae,
 round(avg(abs(err)) FILTER (WHERE model = 'seasonal_naive'), 3) AS baseline_mae, CAST(NULL AS DOUBLE) AS coverage, count(*) FILTER (WHERE model = 'climatology') AS n FROM err GROUP BY 1""")
def holdout_eval(t):
    return rnd(O.holdout(days(t), "climatology", *KEYS, CUT), 3)


@query("holdout_champion")
def holdout_champion(t):
    """The backtest's winner, whichever it is, against the naive baseline on the year after the cut."""
    best = O.champion(O.summary(all_errors(t))).first()["model"]
    return O.holdout(days(t), best, *KEYS, CUT).withColumn("model", F.lit(best))


@query("interval_coverage")
def interval_coverage(t):
    return O.interval_coverage(O.run_model("harmonic_arma", days(t), *KEYS, [CUT], 365))
