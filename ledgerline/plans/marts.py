"""Mart, panel features, entity KPIs, segments and allocation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import allocate as A
from ..operators import gates as G
from ..operators import kpi as K
from ..operators import mart as M
from ..operators import panel as N
from ..operators.metrics import against_baseline
from ..session import fresh_path, materialised
from ..sources import feeds as S
from .registry import query

c = F.col

MART = """
cust_year AS (SELECT n_nationkey, n_name, n_regionkey, CAST(year(o_orderdate) AS INTEGER) AS year,
    sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents, count(*) AS n, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3, 4),
gdp AS (
  SELECT n_name AS country, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code, year, CAST(cents AS DOUBLE) / 100 AS gdp, false AS is_aggregate FROM cust_year
  UNION ALL
  SELECT r_name, 'R' || r_regionkey, year, CAST(sum(cents) AS DOUBLE) / 100, true FROM cust_year JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, r_regionkey, year),
rates AS (SELECT n_name AS country, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code, year, round(100.0 * urgent / n, 6) AS rate FROM cust_year),
dim AS (
  SELECT CAST(row_number() OVER (ORDER BY src, country_code) AS INTEGER) AS country_key, country, country_code, is_aggregate FROM (
    SELECT src, country, country_code, is_aggregate FROM (
      SELECT 0 AS src, country, country_code, is_aggregate FROM gdp UNION ALL SELECT 1, country, country_code, false FROM rates)
    QUALIFY row_number() OVER (PARTITION BY country_code ORDER BY src, country, is_aggregate) = 1)),
fact_gdp AS (SELECT country_key, year, min(gdp) AS gdp FROM gdp JOIN dim USING (country_code) WHERE gdp > 0 GROUP BY 1, 2),
fact_rate AS (SELECT country_key, year, min(rate) AS rate FROM rates JOIN dim USING (country_code) GROUP BY 1, 2)
"""

MONTHLY = """
prices AS (SELECT c_mktsegment AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS price, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
monthly AS (SELECT series_id, month, price, CASE WHEN month >= DATE '2001-06-01' THEN NULL ELSE CAST(n AS DOUBLE) END AS cpi,
    CASE WHEN month >= DATE '2001-06-01' THEN NULL ELSE price / n END AS real_price,
    price / lag(price) OVER (PARTITION BY series_id ORDER BY month) - 1 AS monthly_return, CAST(year(month) AS INTEGER) AS year FROM prices)
"""


def mart_tables(t) -> dict[str, DataFrame]:
    gdp_src, rate_src = S.annual_sources(t)
    gdp = M.annual_fact(gdp_src, "gdp", S.REGION_CODES)
    rate = M.annual_fact(rate_src, "rate", None, positive=False)
    dim = M.conform_dimension([gdp, rate])
    return {
        "dim_country": dim,
        "fact_gdp_annual": M.key_fact(gdp, dim, "gdp"),
        "fact_rate_annual": M.key_fact(rate, dim, "rate"),
        "fact_price_monthly": M.monthly_fact(S.monthly_prices(t)),
    }


@query("mart_fact_annual", f"WITH {MART} SELECT country, country_code, year, gdp, is_aggregate FROM gdp WHERE gdp > 0")
def mart_fact_annual(t):
    return M.annual_fact(S.annual_sources(t)[0], "gdp", S.REGION_CODES)


@query("mart_fact_rate", f"WITH {MART} SELECT country, country_code, year, rate FROM rates")
def mart_fact_rate(t):
    return M.annual_fact(S.annual_sources(t)[1], "rate", None, positive=False)


@query("mart_fact_monthly", f"WITH {MONTHLY} SELECT * REPLACE (CAST(month AS VARCHAR) AS month, round(monthly_return, 9) AS monthly_return) FROM monthly")
def mart_fact_monthly(t):
    return M.monthly_fact(S.monthly_prices(t)).withColumn("monthly_return", F.round("monthly_return", 9))


@query("dim_surrogate", f"WITH {MART} SELECT * FROM dim")
def dim_surrogate(t):
    return mart_tables(t)["dim_country"]


@query("mart_load_counts", f"""WITH {MART}, {MONTHLY}
SELECT 'dim_country' AS table_name, count(*) AS rows FROM dim UNION ALL SELECT 'fact_gdp_annual', count(*) FROM fact_gdp
UNION ALL SELECT 'fact_rate_annual', count(*) FROM fact_rate UNION ALL SELECT 'fact_price_monthly', count(*) FROM monthly""")
def mart_load_counts(t):
    """Full-replace load of the star schema into fresh tables, then their row counts."""
    return M.load_counts(M.load_mart(mart_tables(t), fresh_path(t.spark, "mart")))


@query("mart_checks", f"""WITH {MART}, {MONTHLY}
SELECT 'gdp orphaned from dimension' AS check_name, (SELECT count(*) FROM fact_gdp ANTI JOIN dim USING (country_key)) AS failing_rows
UNION ALL SELECT 'rate orphaned from dimension', (SELECT count(*) FROM fact_rate ANTI JOIN dim USING (country_key))
UNION ALL SELECT 'gdp year out of range', count(*) FILTER (WHERE year < 1996 OR year > 2026) FROM fact_gdp
UNION ALL SELECT 'monthly price not positive', count(*) FILTER (WHERE price <= 0) FROM monthly
UNION ALL SELECT 'monthly return implausible', count(*) FILTER (WHERE abs(monthly_return) > 0.6) FROM monthly
UNION ALL SELECT 'monthly period repeated', count(*) - count(DISTINCT series_id || CAST(month AS VARCHAR)) FROM monthly""")
def mart_checks(t):
    tables = mart_tables(t)
    monthly = tables["fact_price_monthly"].withColumn("period_id", F.concat("series_id", c("month").cast("string")))
    return M.mart_checks(tables["dim_country"], {"gdp": tables["fact_gdp_annual"], "rate": tables["fact_rate_annual"]},
                         "gdp", monthly, "price", (1996, 2026))


@query("mart_slice", f"""WITH {MART} SELECT country, year, gdp / 1e6 AS gdp_m FROM fact_gdp JOIN dim USING (country_key)
WHERE country_code IN ('N00', 'N03', 'N06', 'N09', 'N12', 'N18', 'N24')""")
def mart_slice(t):
    """Seven chosen members of the dimension, value in millions, in reporting order."""
    tables = mart_tables(t)
    chosen = tables["dim_country"].filter(c("country_code").isin("N00", "N03", "N06", "N09", "N12", "N18", "N24"))
    return (tables["fact_gdp_annual"].join(chosen, "country_key").select("country", "year", (c("gdp") / 1e6).alias("gdp_m"))
            .orderBy("country", "year"))


@query("compound_return", f"""WITH {MONTHLY} SELECT series_id, year, round(exp(sum(ln(1 + monthly_return))) - 1, 6) AS annual_return
FROM monthly WHERE monthly_return IS NOT NULL GROUP BY 1, 2""")
def compound_return(t):
    monthly = M.monthly_fact(S.monthly_prices(t)).dropna(subset=["monthly_return"])
    return monthly.groupBy("series_id", "year").agg(F.round(F.exp(F.sum(F.log1p("monthly_return"))) - 1, 6).alias("annual_return"))


# ---------------------------------------------------------------- panel

PANEL = """
panel AS (SELECT c_nationkey AS nation, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, count(*) AS demand,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 1e7 AS driver
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
aged AS (SELECT p.*, n_name, datediff('month', first_month, month_start) AS months_since_launch, month(month_start) AS month_of_year
  FROM panel p JOIN (SELECT nation, min(month_start) AS first_month FROM panel GROUP BY 1) USING (nation) JOIN nation ON n_nationkey = nation),
features AS (SELECT * FROM (SELECT *, lag(demand, 1) OVER w AS demand_lag1, lag(demand, 2) OVER w AS demand_lag2, lag(demand, 3) OVER w AS demand_lag3,
    avg(demand) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS demand_ma3, lag(driver, 1) OVER w AS driver_lag1, lag(driver, 2) OVER w AS driver_lag2,
    lead(demand) OVER w AS target_next FROM aged WINDOW w AS (PARTITION BY nation ORDER BY month_start))
  WHERE demand_lag3 IS NOT NULL AND target_next IS NOT NULL)
"""


def aged_panel(t) -> DataFrame:
    named = S.nation_panel(t).join(F.broadcast(t.nation.select(c("n_nationkey").alias("nation"), "n_name")), "nation")
    return N.with_launch_age(named, "nation")


def feature_table(t) -> DataFrame:
    return N.lag_features(aged_panel(t), ["nation"], "month_start", "demand", "driver")


@query("launch_age", f"WITH {PANEL} SELECT * REPLACE (CAST(month_start AS VARCHAR) AS month_start, CAST(months_since_launch AS INTEGER) AS months_since_launch, CAST(month_of_year AS INTEGER) AS month_of_year) FROM aged")
def launch_age(t):
    return aged_panel(t)


@query("panel_features", f"""WITH {PANEL} SELECT * REPLACE (CAST(month_start AS VARCHAR) AS month_start, CAST(months_since_launch AS INTEGER) AS months_since_launch,
 CAST(month_of_year AS INTEGER) AS month_of_year, round(demand_ma3, 6) AS demand_ma3) FROM features""")
def panel_features(t):
    return feature_table(t).withColumn("demand_ma3", F.round("demand_ma3", 6))


@query("panel_densified", """WITH p AS (SELECT c_nationkey AS nation, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS demand
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
span AS (SELECT nation, unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH))::DATE AS m FROM p GROUP BY nation)
SELECT nation, CAST(m AS VARCHAR) AS month_start, COALESCE(demand, 0) AS demand FROM span LEFT JOIN p USING (nation, m)""")
def panel_densified(t):
    """Missing months put in before positional lags, so that a lag means a month."""
    return N.densify_months(S.nation_panel(t).drop("driver"), ["nation"], "month_start", {"demand": 0})


@query("time_split", f"""WITH {PANEL} SELECT CASE WHEN month_start < DATE '2000-06-01' THEN 'train' ELSE 'test' END AS part, count(*) AS rows, CAST(sum(target_next) AS BIGINT) AS target
FROM features GROUP BY 1""")
def time_split(t):
    train, test = N.split_by_date(feature_table(t), "month_start", "2000-06-01")
    return reduce(DataFrame.unionByName, [
        df.groupBy(F.lit(name).alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.sum("target_next").alias("target"))
        for name, df in (("train", train), ("test", test))])


@query("baseline_gate", f"""WITH {PANEL} SELECT count(*) AS rows, round(avg(abs(target_next - demand)), 6) AS mae_naive,
 round(avg(abs(target_next - demand) / abs(target_next)), 6) AS mape_naive, round(avg(abs(target_next - demand_ma3)), 6) AS mae_model,
 round(avg(abs(target_next - demand_ma3) / abs(target_next)), 6) AS mape_model,
 round(1 - avg(abs(target_next - demand_ma3)) / avg(abs(target_next - demand)), 6) AS improvement FROM features WHERE month_start >= DATE '2000-06-01'""")
def baseline_gate(t):
    """A forecast must beat "next month = this month"; here the forecast is the 3-month mean."""
    _, test = N.split_by_date(feature_table(t), "month_start", "2000-06-01")
    return against_baseline(test, "target_next", "demand_ma3", "demand")


@query("schema_tests", f"""WITH {PANEL}
SELECT 'panel.demand not null' AS test, count(*) FILTER (WHERE demand IS NULL) AS failures FROM panel
UNION ALL SELECT 'orders.o_orderpriority accepted values', count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) FROM orders
UNION ALL SELECT 'orders.o_custkey relationship', (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'aged.months_since_launch not null', count(*) FILTER (WHERE months_since_launch IS NULL) FROM aged
UNION ALL SELECT 'features.target_next not null', count(*) FILTER (WHERE target_next IS NULL) FROM features
UNION ALL SELECT 'aged grain unique', (SELECT count(*) FROM (SELECT nation, month_start FROM aged GROUP BY 1, 2 HAVING count(*) > 1))
UNION ALL SELECT 'lineitem grain unique', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
UNION ALL SELECT 'no negative demand', count(*) FILTER (WHERE demand < 0) FROM aged""")
def schema_tests(t):
    """Column tests and assertion queries; two of them are meant to find failing rows in these tables."""
    aged, features = aged_panel(t), feature_table(t)
    return reduce(DataFrame.unionByName, [
        G.not_null_test(S.nation_panel(t), "panel", "demand"),
        G.accepted_values_test(t.orders, "orders", "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
        G.relationship_test(t.orders, "orders", "o_custkey", t.customer, "c_custkey"),
        G.not_null_test(aged, "aged", "months_since_launch"),
        G.not_null_test(features, "features", "target_next"),
        G.unique_grain_test(aged, "aged", ["nation", "month_start"]),
        G.unique_grain_test(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"]),
        G.no_rows_test(aged, "no negative demand", c("demand") < 0),
    ])


# ---------------------------------------------------------------- entity KPIs, segments, allocation

KPI = """
em AS (SELECT o_custkey AS entity_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, count(*) AS market,
    count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS own FROM orders GROUP BY 1, 2),
win AS (SELECT *, CASE WHEN month_start > mx - INTERVAL 3 MONTH THEN 'L3M' WHEN month_start > mx - INTERVAL 6 MONTH THEN 'P3M'
    WHEN month_start > mx - INTERVAL 12 MONTH THEN 'PRIOR' ELSE 'OLD' END AS win FROM em, (SELECT max(month_start) AS mx FROM em)),
slopes AS (SELECT entity_id, regr_slope(CAST(own AS DOUBLE) / market, datediff('day', DATE '1970-01-01', month_start) / 30.0) AS sl FROM em GROUP BY 1),
agg AS (SELECT entity_id, CAST(sum(market) FILTER (WHERE win IN ('L3M', 'P3M')) AS BIGINT) AS m6, CAST(sum(own) FILTER (WHERE win IN ('L3M', 'P3M')) AS BIGINT) AS o6,
    CAST(sum(own) FILTER (WHERE win = 'L3M') AS DOUBLE) / NULLIF(sum(market) FILTER (WHERE win = 'L3M'), 0) AS share_l3m,
    CAST(sum(own) FILTER (WHERE win = 'P3M') AS DOUBLE) / NULLIF(sum(market) FILTER (WHERE win = 'P3M'), 0) AS share_p3m FROM win GROUP BY 1),
eff AS (SELECT user_id AS entity_id, count(*) AS calls FROM events, (SELECT max(ts) AS mx FROM events)
  WHERE date_trunc('month', ts) > date_trunc('month', mx) - INTERVAL 6 MONTH GROUP BY 1),
kpi AS (SELECT c_custkey AS entity_id, c_mktsegment, c_nationkey, COALESCE(m6, 0) AS market_l6m, COALESCE(o6, 0) AS own_l6m,
    CAST(COALESCE(o6, 0) AS DOUBLE) / NULLIF(m6, 0) AS own_share_l6m, share_l3m, share_p3m,
    CASE WHEN isnan(sl) THEN NULL ELSE sl END AS share_slope_pm, COALESCE(calls, 0) AS calls_l6m,
    CAST(COALESCE(calls, 0) AS DOUBLE) / NULLIF(m6, 0) AS calls_per_market
  FROM customer LEFT JOIN agg ON c_custkey = agg.entity_id LEFT JOIN slopes ON c_custkey = slopes.entity_id LEFT JOIN eff ON c_custkey = eff.entity_id),
seg AS (SELECT *, CASE WHEN market_l6m >= cut AND round(share_slope_pm, 9) <= -0.004 THEN 'DEFEND (at risk)' WHEN market_l6m >= cut AND round(share_slope_pm, 9) >= 0.004 THEN 'GROW (headroom)'
    WHEN market_l6m >= cut THEN 'MAINTAIN (loyal)' ELSE 'MONITOR (low potential)' END AS segment
  FROM kpi, (SELECT quantile_cont(CAST(market_l6m AS DOUBLE), 0.45) AS cut FROM kpi)),
based AS (SELECT *, CASE segment WHEN 'DEFEND (at risk)' THEN 0.55 WHEN 'GROW (headroom)' THEN 0.45 WHEN 'MAINTAIN (loyal)' THEN 0.15 ELSE 0.05 END::DOUBLE * sqrt(CAST(market_l6m AS DOUBLE)) AS base FROM seg),
units AS (SELECT entity_id, k, round(base * power(0.85::DOUBLE, k), 9) AS m FROM based, (SELECT unnest(range(12)) AS k)),
taken AS (SELECT entity_id, CAST(count(*) AS INTEGER) AS n FROM (SELECT entity_id, row_number() OVER (ORDER BY m DESC, entity_id, k) AS r FROM units) WHERE r <= (SELECT sum(calls_l6m) FROM kpi) GROUP BY 1),
plan AS (SELECT based.*, COALESCE(n, 0) AS units_optimized FROM based LEFT JOIN taken USING (entity_id))
"""
ROUND_KPI = "round(own_share_l6m, 6) AS own_share_l6m, round(share_l3m, 6) AS share_l3m, round(share_p3m, 6) AS share_p3m, round(share_slope_pm, 6) AS share_slope_pm, round(calls_per_market, 6) AS calls_per_market"


def kpi_table(t) -> DataFrame:
    spine, monthly, calls = S.entity_months(t)
    return K.entity_kpis(spine, monthly, calls, "entity_id")


def segmented(t) -> DataFrame:
    # Slopes are compared with the cut at nine digits, so that summation order cannot flip a class.
    return K.rule_segments(kpi_table(t).withColumn("share_slope_pm", F.round("share_slope_pm", 9)))


def call_plan(t) -> DataFrame:
    # The rank search reads the entity table several times, so it is written once.
    based = materialised(segmented(t).withColumn("base", A.first_unit_value()))
    capacity = based.agg(F.sum("calls_l6m").alias("s")).first()["s"]
    return A.allocate(based, "entity_id", "base", int(capacity or 0))


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    return df.select(*[F.round(x, digits).alias(x) if x in columns else c(x) for x in df.columns])


SHARES = ["own_share_l6m", "share_l3m", "share_p3m", "share_slope_pm", "share_momentum", "calls_per_market"]


@query("period_windows", f"WITH {KPI} SELECT entity_id, CAST(month_start AS VARCHAR) AS month_start, market, own, win FROM win")
def period_windows(t):
    return K.with_period(S.entity_months(t)[1])


@query("share_slope", f"WITH {KPI} SELECT entity_id, round(CASE WHEN isnan(sl) THEN NULL ELSE sl END, 6) AS share_slope_pm FROM slopes")
def share_slope(t):
    monthly = S.entity_months(t)[1]
    return rounded(monthly.groupBy("entity_id").agg(*K.share_slope("entity_id", "market", "own", "month_start")), ["share_slope_pm"])


@query("entity_kpis", f"WITH {KPI} SELECT * REPLACE ({ROUND_KPI}), round(share_slope_pm * 3, 6) AS share_momentum FROM kpi")
def entity_kpis(t):
    return rounded(kpi_table(t), SHARES)


@query("kpi_checks", f"""WITH {KPI} SELECT 'duplicate entities' AS chk, count(*) - count(DISTINCT entity_id) AS fails FROM kpi
UNION ALL SELECT 'share outside [0,1]', count(*) FILTER (WHERE own_share_l6m < 0 OR own_share_l6m > 1) FROM kpi""")
def kpi_checks(t):
    return K.kpi_checks(kpi_table(t), "entity_id")


@query("rule_segments", f"WITH {KPI} SELECT entity_id, market_l6m, segment FROM seg")
def rule_segments(t):
    return segmented(t).select("entity_id", "market_l6m", "segment")


@query("allocate_capacity", f"WITH {KPI} SELECT entity_id, segment, calls_l6m, units_optimized FROM plan")
def allocate_capacity(t):
    return call_plan(t).select("entity_id", "segment", "calls_l6m", "units_optimized")


@query("allocation_value", f"""WITH {KPI}, v AS (SELECT sum(base * (1 - power(0.85::DOUBLE, least(calls_l6m, 12))) / 0.15) AS a, sum(base * (1 - power(0.85::DOUBLE, units_optimized)) / 0.15) AS b,
 CAST(sum(calls_l6m) - sum(units_optimized) AS BIGINT) AS unused_capacity FROM plan)
SELECT round(a, 4) AS ev_current, round(b, 4) AS ev_optimized, unused_capacity, round(b / a - 1, 6) AS uplift FROM v""")
def allocation_value(t):
    value = A.allocation_value(call_plan(t), "base", "calls_l6m", "units_optimized")
    return rounded(rounded(value, ["ev_current", "ev_optimized"], 4), ["uplift"])


@query("coverage", f"""WITH {KPI} SELECT round(avg(CAST(calls_l6m >= 4 AS INTEGER)), 6) AS coverage_now, round(avg(CAST(units_optimized >= 4 AS INTEGER)), 6) AS coverage_opt
FROM plan WHERE segment IN ('DEFEND (at risk)', 'GROW (headroom)')""")
def coverage(t):
    return rounded(A.coverage(call_plan(t), "calls_l6m", "units_optimized"), ["coverage_now", "coverage_opt"])


@query("segment_table", f"""WITH {KPI} SELECT segment, count(*) AS entities, CAST(sum(market_l6m) AS BIGINT) AS market, round(avg(own_share_l6m), 6) AS own_share,
 CAST(sum(calls_l6m) AS BIGINT) AS calls_now, CAST(sum(units_optimized) AS BIGINT) AS calls_opt FROM plan GROUP BY 1""")
def segment_table(t):
    return A.segment_table(call_plan(t), "calls_l6m", "units_optimized")
