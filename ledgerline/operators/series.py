"""Statistics of regular series ``(series_id, time, value)``.

Input is at calendar grain, one row per series and period, so a window over a
series holds at most as many rows as there are periods; raw events are always
aggregated to that grain first.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import chi2_sf, normal_quantile
from .ordered import exact_quantiles, with_quantiles


def _over(series: str, time: str):
    return Window.partitionBy(series).orderBy(time)


# ---------------------------------------------------------------- returns and levels


def returns(df: DataFrame, series: str, time: str, value: str) -> DataFrame:
    """Adds ``ret`` and ``log_ret`` against the previous row; nothing is padded, NULL in gives NULL out."""
    ret = F.try_divide(F.col(value), F.lag(value).over(_over(series, time))) - 1
    return df.withColumn("ret", ret).withColumn("log_ret", F.log1p("ret"))


def change_over(df: DataFrame, series: str, time: str, value: str, k: int, name: str) -> DataFrame:
    """Relative change over k rows back."""
    return df.withColumn(name, F.try_divide(F.col(value), F.lag(value, k).over(_over(series, time))) - 1)


def forward_return(df: DataFrame, series: str, time: str, value: str, k: int, per_year: int, name: str) -> DataFrame:
    """Annualised return over the next k rows."""
    growth = F.try_divide(F.lead(value, k).over(_over(series, time)), F.col(value))
    return df.withColumn(name, F.pow(growth, F.lit(per_year / k)) - 1)


def rolling_volatility(df: DataFrame, series: str, time: str, value: str, window: int, per_year: int, name: str) -> DataFrame:
    """Sample deviation over full windows only, annualised, in percent."""
    w = _over(series, time).rowsBetween(-(window - 1), 0)
    full = F.count(value).over(w) == window
    return df.withColumn(name, F.when(full, F.stddev_samp(value).over(w) * math.sqrt(per_year) * 100))


def drawdown(df: DataFrame, series: str, time: str, value: str) -> DataFrame:
    """Distance below the running maximum."""
    peak = F.max(value).over(_over(series, time).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("drawdown", F.try_divide(F.col(value), peak) - 1)


def worst_drawdown(df: DataFrame, series: str, time: str) -> DataFrame:
    """Deepest drawdown per series and its first date."""
    return df.groupBy(series).agg(F.min(F.struct("drawdown", time)).alias("w")).select(
        series, F.col("w.drawdown").alias("max_drawdown"), F.col(f"w.{time}").alias("at")
    )


def growth_index(df: DataFrame, series: str, time: str, values: list[str]) -> DataFrame:
    """Each column relative to its first non-NULL value in the series."""
    w = _over(series, time).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select(series, time, *[
        F.try_divide(F.col(v), F.first(v, ignorenulls=True).over(w)).alias(f"{v}_growth") for v in values
    ])


# ---------------------------------------------------------------- distribution


def moments(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, mean, deviation, quartiles, and bias-corrected skewness and excess kurtosis.

    Spark's skewness and kurtosis are population moments; the sample
    corrections need at least 3 and 4 values, and a spread.
    """
    x = F.col(value)
    rows = df.filter(x.isNotNull())
    g = rows.groupBy(*by).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.skewness(x).alias("_g1"), F.kurtosis(x).alias("_g2"),
    )
    g = with_quantiles(g, exact_quantiles(rows, value, {"p25": 0.25, "median": 0.5, "p75": 0.75}, by), by)
    n = F.col("n").cast("double")
    skew = F.when((n > 2) & (F.col("std") > 0), F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when((n > 3) & (F.col("std") > 0), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("_g2") + 6))
    return g.select(
        *by, "n", "mean", "std", "min", "p25", "median", "p75", "max", skew.alias("skew"), kurt.alias("kurtosis"),
    )


def jarque_bera(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Normality statistic from population moments; the chi-square tail with two degrees is exp(-JB/2)."""
    x = F.col(value)
    g = df.filter(x.isNotNull()).groupBy(*by).agg(F.count(x).alias("n"), F.skewness(x).alias("s"), F.kurtosis(x).alias("k"))
    stat = F.col("n") / 6.0 * (F.col("s") * F.col("s") + F.col("k") * F.col("k") / 4.0)
    return g.select(*by, "n", stat.alias("jb"), F.exp(-stat / 2).alias("p"))


def guarded_corr(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over pairwise non-NULL rows; NULL instead of an error for a constant column."""
    x, y = (F.col(v) if isinstance(v, str) else v for v in (a, b))
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    spread = (F.min(px) < F.max(px)) & (F.min(py) < F.max(py))
    return F.when(spread, F.covar_pop(px, py) / F.nullif(F.stddev_pop(px) * F.stddev_pop(py), F.lit(0.0)))


def corr_matrix(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """All pairs in one aggregation, as rows ``a, b, corr``."""
    pairs = [(a, b) for a in columns for b in columns]
    unique = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    agg = df.groupBy(*by).agg(*[guarded_corr(a, b).alias(f"{a}|{b}") for a, b in unique])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                 F.col(f"`{a}|{b}`" if (a, b) in unique else f"`{b}|{a}`").alias("corr"))
        for a, b in pairs
    ]
    return agg.select(*by, F.inline(F.array(*cells)))


def mean_band(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Group mean with its 95% band, 1.96 standard errors wide on each side."""
    x = F.col(value)
    return df.groupBy(*by).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), (1.96 * F.stddev_samp(x) / F.sqrt(F.count(x))).alias("half_width")
    )


def box_summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 IQR of the box) and outlier count per group.  Rows without a group or value are left out."""
    x = F.col(value)
    rows = df.filter(x.isNotNull())
    for b in by:
        rows = rows.filter(F.col(b).isNotNull())
    box = exact_quantiles(rows, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by)
    # Equal values are counted first, so a hot group reaches the join as its distinct values per task.
    counts = rows.groupBy(*by, x.alias("_x")).agg(F.count(F.lit(1)).alias("_m"))
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col("_x") >= F.col("q1") - 1.5 * iqr) & (F.col("_x") <= F.col("q3") + 1.5 * iqr)
    return counts.join(box, by).groupBy(*by, "q1", "median", "q3").agg(
        F.sum("_m").alias("n"), F.min(F.when(inside, F.col("_x"))).alias("whisker_low"), F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("_m"))).alias("outliers"),
    ).select(*by, "n", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers")


def histogram(df: DataFrame, value: str, bins: int = 120) -> DataFrame:
    """``bin, low, rows, density`` in equal bins over the full range; the maximum belongs to the last bin."""
    x = F.col(value)
    rows = df.select(x).filter(x.isNotNull())
    # One row of bounds, whatever the size of the data.
    bounds = rows.agg(F.min(x).alias("_a"), F.max(x).alias("_z"), F.count(x).alias("_n"))
    width = (F.col("_z") - F.col("_a")) / bins
    index = F.least(F.coalesce(F.floor(F.try_divide(x - F.col("_a"), width)), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = rows.join(F.broadcast(bounds)).groupBy(index.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.any_value("_a").alias("_a"), F.any_value("_z").alias("_z"), F.any_value("_n").alias("_n")
    )
    return counts.select("bin", (F.col("_a") + F.col("bin") * width).alias("low"), "rows",
                         F.try_divide(F.col("rows").cast("double"), F.col("_n") * width).alias("density"))


def extremes(df: DataFrame, value: str, ties: list[str], n: int = 8) -> DataFrame:
    """The n smallest and the n largest values."""
    rows = df.filter(F.col(value).isNotNull())
    small = rows.orderBy(F.col(value).asc(), *ties).limit(n).withColumn("side", F.lit("smallest"))
    large = rows.orderBy(F.col(value).desc(), *ties).limit(n).withColumn("side", F.lit("largest"))
    return small.unionByName(large)


def qq_points(df: DataFrame, series: str, value: str) -> DataFrame:
    """Ordered values against the normal quantiles of their expected ranks (Filliben's medians)."""
    rows = df.filter(F.col(value).isNotNull())
    ranked = rows.select(
        series, F.col(value).alias("sample"),
        F.row_number().over(Window.partitionBy(series).orderBy(value)).alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy(series)).alias("n"),
    )
    last = F.pow(F.lit(0.5), 1.0 / F.col("n"))
    position = F.when(F.col("i") == F.col("n"), last).when(F.col("i") == 1, 1 - last).otherwise(
        (F.col("i") - 0.3175) / (F.col("n") + 0.365)
    )
    return ranked.select(series, "i", normal_quantile(position).alias("theoretical"), "sample")


# ---------------------------------------------------------------- regression


def ols_line(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Slope and intercept, once by the built-in and once by the normal equations as a cross-check."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    g = df.groupBy(*by).agg(
        F.regr_slope(b, a).alias("slope"), F.regr_intercept(b, a).alias("intercept"), F.count(a).alias("n"),
        F.sum(a).alias("sx"), F.sum(b).alias("sy"), F.sum(a * a).alias("sxx"), F.sum(a * b).alias("sxy"),
    )
    det = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    return g.select(*by, "n", "slope", "intercept",
                    F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), det).alias("slope_normal"))


def ols_gram(df: DataFrame, features: dict[str, Column], y: str) -> DataFrame:
    """Least squares with several regressors: Gram sums on Spark, a tiny solve, then the residual check.

    Returns ``term, beta, rel_orthogonality``; the last is the largest |A'r| relative
    to |A'y| and must be near 0, as residuals are orthogonal to the design.
    """
    terms = {"const": F.lit(1.0), **features}
    names = list(terms)
    design = df.select(F.col(y).cast("double").alias("_y"), *[v.cast("double").alias(f"_f{i}") for i, v in enumerate(terms.values())])
    design = design.dropna()
    k = len(names)
    sums = [F.sum(F.col(f"_f{i}") * F.col(f"_f{j}")).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
    sums += [F.sum(F.col(f"_f{i}") * F.col("_y")).alias(f"y{i}") for i in range(k)]
    row = design.agg(*sums).first()
    gram = np.array([[row[f"g{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)], dtype=float)
    right = np.array([row[f"y{i}"] for i in range(k)], dtype=float)
    beta = np.linalg.solve(gram, right)
    fitted = F.lit(0.0)
    for i in range(k):
        fitted = fitted + F.lit(float(beta[i])) * F.col(f"_f{i}")
    residual = F.col("_y") - fitted
    check = design.agg(*[F.abs(F.sum(F.col(f"_f{i}") * residual)).alias(f"r{i}") for i in range(k)])
    worst = F.greatest(*[F.col(f"r{i}") for i in range(k)]) / float(np.abs(right).max())
    cells = [F.struct(F.lit(n).alias("term"), F.lit(float(b)).alias("beta")) for n, b in zip(names, beta)]
    return check.select(worst.alias("rel_orthogonality"), F.inline(F.array(*cells)))


# ---------------------------------------------------------------- dependence


def autocorr1(df: DataFrame, series: str, time: str, value: str) -> DataFrame:
    """Pearson correlation of the series with itself one row earlier, for values and absolute values."""
    lagged = df.filter(F.col(value).isNotNull()).withColumn("_lag", F.lag(value).over(_over(series, time)))
    return lagged.groupBy(series).agg(
        guarded_corr(value, "_lag").alias("acf1"), guarded_corr(F.abs(value), F.abs("_lag")).alias("acf1_abs")
    )


def acf(df: DataFrame, series: str, time: str, value: str, lags: int = 36) -> DataFrame:
    """Biased autocorrelation ``series, lag, rho, band`` with the Bartlett 95% band; all lags in one window pass."""
    rows = df.filter(F.col(value).isNotNull())
    mean = rows.groupBy(series).agg(F.avg(value).alias("_mean"), F.count(F.lit(1)).alias("n"))
    centred = rows.join(mean, series).select(series, time, "n", (F.col(value) - F.col("_mean")).alias("_x"))
    w = _over(series, time)
    wide = centred.select(series, "n", "_x", *[F.lag("_x", k).over(w).alias(f"_l{k}") for k in range(1, lags + 1)])
    sums = wide.groupBy(series).agg(
        F.any_value("n").alias("n"), F.sum(F.col("_x") * F.col("_x")).alias("_s0"),
        *[F.sum(F.col("_x") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, lags + 1)],
    )
    cells = [F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_s{k}"), F.col("_s0")).alias("rho")) for k in range(1, lags + 1)]
    long = sums.select(series, "n", F.inline(F.array(*cells))).filter(F.col("rho").isNotNull())
    before = Window.partitionBy(series).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(F.col("rho") * F.col("rho")).over(before), F.lit(0.0))
    return long.withColumn("band", 1.959963984540054 * F.sqrt((1 + 2 * earlier) / F.col("n")))


def ljung_box(df: DataFrame, series: str, time: str, value: str, lags: tuple[int, ...] = (7, 14, 30)) -> DataFrame:
    """``series, lag, q, p``: joint test that the first autocorrelations are zero."""
    rho = acf(df, series, time, value, max(lags)).filter(F.col("lag") < F.col("n"))
    term = F.col("rho") * F.col("rho") / (F.col("n") - F.col("lag"))
    sums = rho.groupBy(series).agg(
        F.any_value("n").alias("n"), *[F.sum(F.when(F.col("lag") <= h, term)).alias(f"_q{h}") for h in lags]
    )
    cells = []
    for h in lags:
        q = F.col("n") * (F.col("n") + 2) * F.col(f"_q{h}")
        cells.append(F.struct(F.lit(h).alias("lag"), q.alias("q"), chi2_sf(q, h).alias("p")))
    return sums.select(series, F.inline(F.array(*cells)))


# Response-surface coefficients for the unit-root p-value, constant included, one variable.
ADF_STAR, ADF_MIN, ADF_MAX = -1.61, -18.83, 2.74
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def adf_statistic(x: np.ndarray) -> tuple[float, float, int]:
    """Unit-root t statistic with constant, lag order by AIC on a common sample; returns (stat, p, lags)."""
    x = np.asarray(x, dtype=float)
    n = len(x)
    if n < 12 or np.ptp(x) == 0:
        return float("nan"), float("nan"), 0
    step = np.diff(x)
    longest = min(int(math.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 2)

    def design(drop: int, lags: int):
        m = len(step) - drop
        cols = [x[drop:-1], np.ones(m)] + [step[drop - j:len(step) - j] for j in range(1, lags + 1)]
        return np.column_stack(cols), step[drop:]

    def fit(a: np.ndarray, y: np.ndarray):
        beta, *_ = np.linalg.lstsq(a, y, rcond=None)
        r = y - a @ beta
        return beta, float(r @ r)

    best, lags = math.inf, 0
    for k in range(longest + 1):
        a, y = design(longest, k)
        _, ssr = fit(a, y)
        aic = len(y) * math.log(max(ssr, 1e-300) / len(y)) + 2 * a.shape[1]
        if aic < best - 1e-12:
            best, lags = aic, k
    a, y = design(lags, lags)
    beta, ssr = fit(a, y)
    s2 = ssr / (len(y) - a.shape[1])
    stat = float(beta[0] / math.sqrt(s2 * np.linalg.inv(a.T @ a)[0, 0]))
    if stat > ADF_MAX:
        return stat, 1.0, lags
    if stat < ADF_MIN:
        return stat, 0.0, lags
    coefs = ADF_SMALL_P if stat <= ADF_STAR else ADF_LARGE_P
    z = sum(c * stat**i for i, c in enumerate(coefs))
    return stat, 0.5 * math.erfc(-z / math.sqrt(2)), lags


def adf(df: DataFrame, series: str, time: str, value: str) -> DataFrame:
    """Unit-root test per series; each task gets one series of calendar length."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values(time)[value].to_numpy(dtype=float)
        stat, p, lags = adf_statistic(ordered[~np.isnan(ordered)])
        return pd.DataFrame({series: [pdf[series].iloc[0]], "stat": [stat], "p": [p], "lags": [lags]})

    kind = df.schema[series].dataType.simpleString()
    return df.select(series, time, value).groupBy(series).applyInPandas(run, f"{series} {kind}, stat double, p double, lags int")


# ---------------------------------------------------------------- regular grid


def densify_daily(df: DataFrame, series: str, day: str, value: str) -> DataFrame:
    """Every calendar day between a series' first and last; missing days get NULL."""
    span = df.groupBy(series).agg(F.min(day).alias("_a"), F.max(day).alias("_z"))
    grid = span.select(series, F.explode(F.sequence("_a", "_z", F.expr("interval 1 day"))).alias(day))
    return grid.join(df.select(series, day, value), [series, day], "left")


def gap_count(dense: DataFrame, series: str, value: str) -> DataFrame:
    return dense.groupBy(series).agg(F.count(F.lit(1)).alias("days"), F.count_if(F.col(value).isNull()).alias("gaps"))


def interpolate_linear(dense: DataFrame, series: str, day: str, value: str) -> DataFrame:
    """Straight line between the neighbouring known days; trailing gaps keep the last value, leading ones stay NULL."""
    back = _over(series, day).rowsBetween(Window.unboundedPreceding, 0)
    ahead = _over(series, day).rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.col(day))
    marked = dense.select(
        "*", F.last(value, True).over(back).alias("_pv"), F.last(known, True).over(back).alias("_pd"),
        F.first(value, True).over(ahead).alias("_nv"), F.first(known, True).over(ahead).alias("_nd"),
    )
    weight = F.date_diff(F.col(day), F.col("_pd")) / F.date_diff(F.col("_nd"), F.col("_pd"))
    filled = (
        F.when(F.col(value).isNotNull(), F.col(value))
        .when(F.col("_nv").isNull(), F.col("_pv"))
        .when(F.col("_pv").isNotNull(), F.col("_pv") + (F.col("_nv") - F.col("_pv")) * weight)
    )
    return marked.withColumn("was_gap", F.col(value).isNull()).withColumn(value, filled).drop("_pv", "_pd", "_nv", "_nd")


def seasonal_decompose(df: DataFrame, series: str, time: str, value: str, position: Column, period: int) -> DataFrame:
    """Classical additive decomposition: centred moving mean, mean per season position, remainder.

    An even period uses the usual half weights at both ends; the trend is NULL
    where the window is not full, and the seasonal part sums to 0 over a period.
    """
    w = _over(series, time)
    half = period // 2
    if period % 2:
        frame = w.rowsBetween(-half, half)
        trend = F.when(F.count(value).over(frame) == period, F.avg(value).over(frame))
    else:
        frame = w.rowsBetween(-half, half)
        ends = F.lag(value, half).over(w) + F.lead(value, half).over(w)
        trend = F.when(F.count(value).over(frame) == period + 1, (F.sum(value).over(frame) - ends / 2) / period)
    detrended = df.withColumn("_pos", position).withColumn("trend", trend)
    season = detrended.groupBy(series, "_pos").agg(F.avg(F.col(value) - F.col("trend")).alias("_s"))
    centred = season.withColumn("seasonal", F.col("_s") - F.avg("_s").over(Window.partitionBy(series))).drop("_s")
    return detrended.join(centred, [series, "_pos"]).select(
        series, time, value, "trend", "seasonal", (F.col(value) - F.col("trend") - F.col("seasonal")).alias("remainder")
    )
