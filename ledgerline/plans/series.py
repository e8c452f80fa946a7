"""Series statistics on monthly values per market segment and daily values per order status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import decade
from ..functions.numbers import fourier_columns, right_closed_bin
from ..functions.tails import chi2_sf_sql, normal_quantile_sql
from ..operators import mart as M
from ..operators import series as S
from ..sources.feeds import daily_values, monthly_prices
from .marts import MONTHLY
from .registry import query

c = F.col

SERIES = MONTHLY + """
, m AS (SELECT *, monthly_return AS ret, ln(1 + monthly_return) AS log_ret, CAST(month(month) AS INTEGER) AS moy,
    CAST(year // 10 * 10 AS INTEGER) AS decade, cpi / lag(cpi, 12) OVER (PARTITION BY series_id ORDER BY month) - 1 AS cpi_yoy,
    real_price / lag(real_price) OVER (PARTITION BY series_id ORDER BY month) - 1 AS real_ret,
    power(lead(real_price, 24) OVER (PARTITION BY series_id ORDER BY month) / real_price, 0.5) - 1 AS fwd,
    price / max(price) OVER (PARTITION BY series_id ORDER BY month ROWS UNBOUNDED PRECEDING) - 1 AS drawdown FROM monthly),
v AS (SELECT *, CASE WHEN count(log_ret) OVER w = 36 THEN stddev_samp(log_ret) OVER w * sqrt(12) * 100 END AS vol FROM m
    WINDOW w AS (PARTITION BY series_id ORDER BY month ROWS 35 PRECEDING)),
regimed AS (SELECT *, CASE WHEN cpi_yoy IS NULL THEN NULL WHEN cpi_yoy * 100 <= 0 THEN 'deflation' WHEN cpi_yoy * 100 <= 2 THEN '0-2%' WHEN cpi_yoy * 100 <= 5 THEN '2-5%' ELSE '>5%' END AS regime FROM v)
"""
DAILY = """
daily AS (SELECT o_orderstatus AS series_id, CAST(o_orderdate AS DATE) AS day, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS value FROM orders GROUP BY 1, 2),
span AS (SELECT series_id, unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day FROM daily GROUP BY 1),
dense AS (SELECT series_id, day, value FROM span LEFT JOIN daily USING (series_id, day)),
marked AS (SELECT *, last_value(value IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER b AS pd,
    first_value(value IGNORE NULLS) OVER a AS nv, first_value(CASE WHEN value IS NOT NULL THEN day END IGNORE NULLS) OVER a AS nd FROM dense
  WINDOW b AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY series_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT series_id, day, value IS NULL AS was_gap, CASE WHEN value IS NOT NULL THEN value ELSE pv + (nv - pv) * (CAST(datediff('day', pd, day) AS DOUBLE) / datediff('day', pd, nd)) END AS value FROM marked)
"""


def month_table(t) -> DataFrame:
    """Monthly facts with returns, forward return, yearly change, volatility and drawdown."""
    m = M.monthly_fact(monthly_prices(t))
    m = m.withColumn("ret", c("monthly_return")).withColumn("log_ret", F.log1p("ret"))
    m = S.change_over(m, "series_id", "month", "cpi", 12, "cpi_yoy")
    m = S.change_over(m, "series_id", "month", "real_price", 1, "real_ret")
    m = S.forward_return(m, "series_id", "month", "real_price", 24, 12, "fwd")
    m = S.rolling_volatility(m, "series_id", "month", "log_ret", 36, 12, "vol")
    m = S.drawdown(m, "series_id", "month", "price")
    return m.withColumn("moy", F.month("month")).withColumn("decade", decade("month"))


def filled_days(t) -> DataFrame:
    dense = S.densify_daily(daily_values(t), "series_id", "day", "value")
    return S.interpolate_linear(dense, "series_id", "day", "value")


def rnd(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison."""
    return df.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else c(f.name) for f in df.schema.fields])


@query("returns", f"WITH {SERIES} SELECT series_id, CAST(month AS VARCHAR) AS month, price, round(ret, 6) AS ret, round(log_ret, 6) AS log_ret, round(real_ret, 6) AS real_ret FROM m")
def returns(t):
    base = S.returns(M.monthly_fact(monthly_prices(t)), "series_id", "month", "price")
    base = S.change_over(base, "series_id", "month", "real_price", 1, "real_ret")
    return rnd(base.select("series_id", "month", "price", "ret", "log_ret", "real_ret"))


@query("forward_return", f"WITH {SERIES} SELECT series_id, CAST(month AS VARCHAR) AS month, round(fwd, 6) AS fwd, round(cpi_yoy, 6) AS cpi_yoy FROM m")
def forward_return(t):
    return rnd(month_table(t).select("series_id", "month", "fwd", "cpi_yoy"))


@query("rolling_vol", f"WITH {SERIES} SELECT series_id, CAST(month AS VARCHAR) AS month, round(vol, 5) AS vol FROM v")
def rolling_vol(t):
    return rnd(month_table(t).select("series_id", "month", "vol"), 5)


@query("drawdown", f"""WITH {SERIES} SELECT series_id, round(min(drawdown), 6) AS max_drawdown, CAST(arg_min(month, (drawdown, month)) AS VARCHAR) AS at FROM m GROUP BY 1""")
def drawdown(t):
    return rnd(S.worst_drawdown(month_table(t), "series_id", "month"))


@query("drawdown_path", f"WITH {SERIES} SELECT series_id, CAST(month AS VARCHAR) AS month, round(drawdown, 6) AS drawdown FROM m")
def drawdown_path(t):
    return rnd(month_table(t).select("series_id", "month", "drawdown"))


@query("growth_index", f"""WITH {SERIES} SELECT series_id, CAST(month AS VARCHAR) AS month, round(price / first_value(price) OVER w, 6) AS price_growth,
 round(real_price / first_value(real_price IGNORE NULLS) OVER w, 6) AS real_price_growth FROM m WINDOW w AS (PARTITION BY series_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def growth_index(t):
    return rnd(S.growth_index(M.monthly_fact(monthly_prices(t)), "series_id", "month", ["price", "real_price"]))


@query("seasonal_mean_ci", f"""WITH {SERIES} SELECT moy, count(ret) AS n, round(avg(ret), 6) AS mean, round(1.96 * stddev_samp(ret) / sqrt(count(ret)), 6) AS half_width FROM m WHERE ret IS NOT NULL GROUP BY 1""")
def seasonal_mean_ci(t):
    return rnd(S.mean_band(month_table(t).dropna(subset=["ret"]), ["moy"], "ret"))


def _box_sql(group: str) -> str:
    return f"""WITH {SERIES}, r AS (SELECT {group}, ret FROM regimed WHERE ret IS NOT NULL AND {group} IS NOT NULL),
q AS (SELECT {group}, quantile_cont(ret, 0.25) AS q1, quantile_cont(ret, 0.5) AS median, quantile_cont(ret, 0.75) AS q3 FROM r GROUP BY 1)
SELECT {group}, count(*) AS n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
 round(min(ret) FILTER (WHERE ret >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low, round(max(ret) FILTER (WHERE ret <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
 count(*) FILTER (WHERE ret < q1 - 1.5 * (q3 - q1) OR ret > q3 + 1.5 * (q3 - q1)) AS outliers FROM r JOIN q USING ({group}) GROUP BY 1"""


@query("box_summary", _box_sql("decade"))
def box_summary(t):
    return rnd(S.box_summary(month_table(t), ["decade"], "ret"))


@query("box_by_regime", _box_sql("regime"))
def box_by_regime(t):
    """Return distribution by yearly-change regime, right-closed bins with open ends."""
    regime = right_closed_bin(c("cpi_yoy") * 100, [0, 2, 5], ["deflation", "0-2%", "2-5%", ">5%"])
    return rnd(S.box_summary(month_table(t).withColumn("regime", regime), ["regime"], "ret"))


@query("describe_moments", f"""WITH {SERIES} SELECT series_id, count(log_ret) AS n, round(avg(log_ret), 6) AS mean, round(stddev_samp(log_ret), 6) AS std, round(min(log_ret), 6) AS min,
 round(quantile_cont(log_ret, 0.25), 6) AS p25, round(quantile_cont(log_ret, 0.5), 6) AS median, round(quantile_cont(log_ret, 0.75), 6) AS p75, round(max(log_ret), 6) AS max,
 round(skewness(log_ret), 6) AS skew, round(kurtosis(log_ret), 6) AS kurtosis FROM m WHERE log_ret IS NOT NULL GROUP BY 1""")
def describe_moments(t):
    return rnd(S.moments(month_table(t), ["series_id"], "log_ret"))


@query("jarque_bera", f"""WITH {SERIES}, c AS (SELECT series_id, log_ret - avg(log_ret) OVER (PARTITION BY series_id) AS d FROM m WHERE log_ret IS NOT NULL),
s AS (SELECT series_id, count(*) AS n, avg(d * d) AS m2, avg(d * d * d) AS m3, avg(d * d * d * d) AS m4 FROM c GROUP BY 1),
j AS (SELECT series_id, n, n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4) AS jb FROM s)
SELECT series_id, n, round(jb, 5) AS jb, round(exp(-jb / 2), 5) AS p FROM j""")
def jarque_bera(t):
    return rnd(S.jarque_bera(month_table(t), ["series_id"], "log_ret"), 5)


CORR_COLUMNS = ["ret", "price", "cpi", "vol"]


@query("corr_matrix", f"WITH {SERIES} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM v" for a in CORR_COLUMNS for b in CORR_COLUMNS))
def corr_matrix(t):
    return rnd(S.corr_matrix(month_table(t), [], CORR_COLUMNS))


@query("ols_line", f"""WITH {SERIES} SELECT series_id, CAST(regr_count(fwd, price) AS BIGINT) AS n, round(regr_slope(fwd * 100, price / 1e6), 5) AS slope,
 round(regr_intercept(fwd * 100, price / 1e6), 5) AS intercept, round(regr_slope(fwd * 100, price / 1e6), 5) AS slope_normal FROM m GROUP BY 1""")
def ols_line(t):
    m = month_table(t).select("series_id", (c("price") / 1e6).alias("x"), (c("fwd") * 100).alias("y"))
    return rnd(S.ols_line(m, ["series_id"], "x", "y"), 5)


@query("ols_gram")
def ols_gram(t):
    """Harmonic regression of the daily values, solved from Gram sums over all series."""
    days = filled_days(t).withColumn("t", F.date_diff("day", F.lit("1995-01-01").cast("date")))
    return S.ols_gram(days, fourier_columns("t"), "value")


@query("histogram", """WITH b AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS z, count(*) AS n FROM orders),
h AS (SELECT least(CAST(floor((o_totalprice - a) / ((z - a) / 120)) AS INTEGER), 119) AS bin, any_value(a) AS a, any_value(z) AS z, any_value(n) AS n, count(*) AS rows FROM orders, b GROUP BY 1)
SELECT bin, round(a + bin * ((z - a) / 120), 4) AS low, rows, round(rows / (n * ((z - a) / 120)), 12) AS density FROM h""")
def histogram(t):
    h = S.histogram(t.orders, "o_totalprice", 120)
    return h.select("bin", F.round("low", 4).alias("low"), "rows", F.round("density", 12).alias("density"))


@query("qq_points", f"""WITH {SERIES}, r AS (SELECT series_id, log_ret AS sample, row_number() OVER (PARTITION BY series_id ORDER BY log_ret) AS i, count(*) OVER (PARTITION BY series_id) AS n FROM m WHERE log_ret IS NOT NULL),
q AS (SELECT series_id, i, sample, CASE WHEN i = n THEN power(0.5, 1.0::DOUBLE / n) WHEN i = 1 THEN 1 - power(0.5, 1.0::DOUBLE / n) ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM r)
SELECT series_id, CAST(i AS INTEGER) AS i, round({normal_quantile_sql("p")}, 6) AS theoretical, round(sample, 8) AS sample FROM q""")
def qq_points(t):
    points = S.qq_points(month_table(t), "series_id", "log_ret")
    return points.select("series_id", "i", F.round("theoretical", 6).alias("theoretical"), F.round("sample", 8).alias("sample"))


@query("extremes", """(SELECT o_orderkey, o_totalprice, 'smallest' AS side FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 8)
UNION ALL (SELECT o_orderkey, o_totalprice, 'largest' AS side FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 8)""")
def extremes(t):
    return S.extremes(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"])


@query("autocorr1", f"""WITH {SERIES}, l AS (SELECT series_id, log_ret, lag(log_ret) OVER (PARTITION BY series_id ORDER BY month) AS p FROM m WHERE log_ret IS NOT NULL)
SELECT series_id, round(corr(log_ret, p), 6) AS acf1, round(corr(abs(log_ret), abs(p)), 6) AS acf1_abs FROM l WHERE p IS NOT NULL GROUP BY 1""")
def autocorr1(t):
    return rnd(S.autocorr1(month_table(t), "series_id", "month", "log_ret"))


ACF = SERIES + """
, x AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY month) AS i, log_ret - avg(log_ret) OVER (PARTITION BY series_id) AS d,
    count(*) OVER (PARTITION BY series_id) AS n FROM m WHERE log_ret IS NOT NULL),
acf AS (SELECT a.series_id, lag, any_value(a.n) AS n, sum(a.d * b.d) / any_value(s0) AS rho FROM x a, (SELECT unnest(range(1, 37)) AS lag) l, x b, (SELECT series_id, sum(d * d) AS s0 FROM x GROUP BY 1) s
  WHERE a.series_id = b.series_id AND a.i = b.i + lag AND s.series_id = a.series_id GROUP BY 1, 2)
"""


@query("acf", f"""WITH {ACF} SELECT series_id, CAST(lag AS INTEGER) AS lag, n, round(rho, 6) AS rho,
 round(1.959963984540054 * sqrt((1 + 2 * COALESCE(sum(rho * rho) OVER (PARTITION BY series_id ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n), 6) AS band FROM acf""")
def acf(t):
    return rnd(S.acf(month_table(t), "series_id", "month", "log_ret", 36))


@query("ljung_box", f"WITH {ACF}, q AS (SELECT series_id, CAST(h AS INTEGER) AS lag, any_value(n) * (any_value(n) + 2) * sum(rho * rho / (n - acf.lag)) FILTER (WHERE acf.lag <= h) AS q FROM acf, (SELECT unnest([7, 14, 30]) AS h) GROUP BY 1, 2) " +
       " UNION ALL ".join(f"SELECT series_id, lag, round(q, 5) AS q, round({chi2_sf_sql('q', h)}, 5) AS p FROM q WHERE lag = {h}" for h in (7, 14, 30)))
def ljung_box(t):
    return rnd(S.ljung_box(month_table(t), "series_id", "month", "log_ret"), 5)


@query("adf")
def adf(t):
    """Unit-root tests of log price and of returns, per series."""
    m = month_table(t).withColumn("log_price", F.log("price"))
    return S.adf(m, "series_id", "month", "log_price").withColumn("what", F.lit("log_price")).unionByName(
        S.adf(m.dropna(subset=["log_ret"]), "series_id", "month", "log_ret").withColumn("what", F.lit("log_ret")))


@query("densify_daily", f"WITH {DAILY} SELECT series_id, count(*) AS days, count(*) FILTER (WHERE value IS NULL) AS gaps FROM dense GROUP BY 1")
def densify_daily(t):
    return S.gap_count(S.densify_daily(daily_values(t), "series_id", "day", "value"), "series_id", "value")


@query("interpolate_linear", f"WITH {DAILY} SELECT series_id, CAST(day AS VARCHAR) AS day, was_gap, value FROM filled")
def interpolate_linear(t):
    return filled_days(t)


@query("seasonal_decompose", f"""WITH {SERIES}, tr AS (SELECT series_id, month, moy, price, CASE WHEN count(*) OVER w = 13 THEN
   (sum(price) OVER w - (lag(price, 6) OVER (PARTITION BY series_id ORDER BY month) + lead(price, 6) OVER (PARTITION BY series_id ORDER BY month)) / 2) / 12 END AS trend
   FROM m WINDOW w AS (PARTITION BY series_id ORDER BY month ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
se AS (SELECT series_id, moy, avg(price - trend) AS s FROM tr GROUP BY 1, 2),
ce AS (SELECT series_id, moy, s - avg(s) OVER (PARTITION BY series_id) AS seasonal FROM se)
SELECT series_id, CAST(month AS VARCHAR) AS month, price, round(trend, 3) AS trend, round(seasonal, 3) AS seasonal, round(price - trend - seasonal, 3) AS remainder FROM tr JOIN ce USING (series_id, moy)""")
def seasonal_decompose(t):
    m = M.monthly_fact(monthly_prices(t))
    return rnd(S.seasonal_decompose(m, "series_id", "month", "price", F.month("month"), 12), 3)
