"""Tolerant casts, safe ratios and small closed forms."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_double(col: str | Column) -> Column:
    return _c(col).try_cast("double")


def safe_int(col: str | Column) -> Column:
    """Text to integer, rounding decimals and exponents ('30.6' is 31, '3e1' is 30); junk is NULL."""
    return F.round(_c(col).try_cast("double")).try_cast("int")


def ratio(num: str | Column, den: str | Column) -> Column:
    """NULL where the denominator is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def placeholder_to_null(col: str | Column, placeholder: float = 0.0) -> Column:
    return F.nullif(_c(col), F.lit(placeholder))


def geometric_value(base: str | Column, n: str | Column, decay: float) -> Column:
    """Value of ``n`` units when each is worth ``decay`` times the one before."""
    return _c(base) * (1 - F.pow(F.lit(decay), _c(n))) / (1 - decay)


def right_closed_bin(col: str | Column, edges: list[float], labels: list[str]) -> Column:
    """(-inf, e0], (e0, e1], ... (last, inf): one label more than edges; NULL stays NULL."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    c = _c(col)
    out = F.when(c.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(c <= edge, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def fourier_columns(t: str | Column, k_max: int = 3, period: float = 365.25) -> dict[str, Column]:
    """sin and cos of 2*pi*k*t/period for k = 1..k_max."""
    out: dict[str, Column] = {}
    for k in range(1, k_max + 1):
        angle = _c(t) * F.lit(2.0 * math.pi * k / period)
        out[f"sin{k}"] = F.sin(angle)
        out[f"cos{k}"] = F.cos(angle)
    return out
