"""Tails of the normal, chi-square and t distributions.

The normal and the integer-degree chi-square are column expressions and stay
in the JVM.  Only the t tail with fractional degrees needs Python.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Coefficients of the rational-exponential fit to erfc (relative error below 1.2e-7 everywhere).
ERFC_COEFFICIENTS = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
)


def erfc(x: Column) -> Column:
    ax = F.abs(x)
    t = F.lit(1.0) / (1.0 + 0.5 * ax)
    poly = F.lit(ERFC_COEFFICIENTS[-1])
    for coef in reversed(ERFC_COEFFICIENTS[:-1]):
        poly = F.lit(coef) + t * poly
    tail = t * F.exp(-ax * ax + poly)
    return F.when(x >= 0, tail).otherwise(2.0 - tail)


def erfc_sql(x: str) -> str:
    """The same fit as SQL text, for checking in another engine."""
    t = f"(1.0/(1.0+0.5*abs({x})))"
    poly = str(ERFC_COEFFICIENTS[-1])
    for coef in reversed(ERFC_COEFFICIENTS[:-1]):
        poly = f"({coef}+{t}*{poly})"
    tail = f"({t}*exp(-({x})*({x})+{poly}))"
    return f"(CASE WHEN ({x})>=0 THEN {tail} ELSE 2.0-{tail} END)"


def normal_sf(z: Column) -> Column:
    """P(Z > z)."""
    return 0.5 * erfc(z / math.sqrt(2.0))


def normal_cdf(z: Column) -> Column:
    return 0.5 * erfc(-z / math.sqrt(2.0))


# Coefficients of a published rational approximation of the normal quantile (relative error below 1.2e-9),
# numerator and denominator in the middle, then in the tails, highest power first.
MIDDLE_TOP = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
MIDDLE_BOTTOM = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01, -1.328068155288572e+01, 1.0]
TAIL_TOP = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
TAIL_BOTTOM = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00, 1.0]
TAIL = 0.02425


def normal_quantile(p: Column) -> Column:
    """Inverse of the normal distribution function as an expression; NULL outside (0, 1)."""
    def powers(x: Column, weights: list[float]) -> Column:
        out = F.lit(weights[0])
        for w in weights[1:]:
            out = out * x + F.lit(w)
        return out

    side = F.least(p, 1 - p)
    q, r = p - 0.5, (p - 0.5) * (p - 0.5)
    t = F.sqrt(-2 * F.log(side))
    tail = powers(t, TAIL_TOP) / powers(t, TAIL_BOTTOM)
    middle = q * powers(r, MIDDLE_TOP) / powers(r, MIDDLE_BOTTOM)
    return F.when((p <= 0) | (p >= 1), F.lit(None)).when(side >= TAIL, middle).when(p < 0.5, tail).otherwise(-tail)


def normal_quantile_sql(p: str) -> str:
    def powers(x: str, weights: list[float]) -> str:
        out = f"{weights[0]!r}::DOUBLE"
        for w in weights[1:]:
            out = f"({out}*{x}+({w!r}::DOUBLE))"
        return out

    side, q = f"least({p},1-{p})", f"({p}-0.5)"
    r, t = f"({q}*{q})", f"sqrt(-2*ln({side}))"
    tail = f"({powers(t, TAIL_TOP)}/{powers(t, TAIL_BOTTOM)})"
    middle = f"({q}*{powers(r, MIDDLE_TOP)}/{powers(r, MIDDLE_BOTTOM)})"
    return f"CASE WHEN {p}<=0 OR {p}>=1 THEN NULL WHEN {side}>={TAIL} THEN {middle} WHEN {p}<0.5 THEN {tail} ELSE -{tail} END"


def chi2_sf(x: Column, df: int) -> Column:
    """P(X > x) for a whole number of degrees of freedom, by the finite sum."""
    half = x / 2.0
    if df % 2 == 0:
        total = F.lit(0.0)
        for i in range(df // 2):
            total = total + F.pow(half, F.lit(float(i))) / math.gamma(i + 1)
        return F.exp(-half) * total
    total = F.lit(0.0)
    for j in range(1, (df - 1) // 2 + 1):
        total = total + F.pow(half, F.lit(j - 0.5)) / math.gamma(j + 0.5)
    return erfc(F.sqrt(half)) + F.exp(-half) * total


def chi2_sf_sql(x: str, df: int) -> str:
    """The chi-square tail as SQL text, for checking in another engine."""
    half = f"(({x})/2.0)"
    if df % 2 == 0:
        return f"exp(-{half})*(" + "+".join(f"power({half},{i})/{math.gamma(i + 1)!r}" for i in range(df // 2)) + ")"
    terms = "+".join(f"power({half},{j - 0.5})/{math.gamma(j + 0.5)!r}" for j in range(1, (df - 1) // 2 + 1)) or "0"
    return f"({erfc_sql(f'sqrt({half})')}+exp(-{half})*({terms}))"


def _log_beta(a: float, b: float) -> float:
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta integral, evaluated front to back (Lentz)."""
    floor = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > floor else floor)
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            c = 1.0 + step / c
            d = 1.0 / (d if abs(d) > floor else floor)
            c = c if abs(c) > floor else floor
            value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return value


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|); also usable in plain Python."""
    if t is None or df is None or not (math.isfinite(t) and math.isfinite(df)) or df <= 0:
        return float("nan")
    a, b, x = df / 2.0, 0.5, df / (df + t * t)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) - _log_beta(a, b)) if 0 < x < 1 else 0.0
    if x >= 1:
        return 1.0
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


@F.pandas_udf(T.DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p of a t statistic; meant for aggregated rows, never for raw ones."""
    return pd.Series(np.array([t_two_sided(a, b) for a, b in zip(t, df)], dtype=float))
