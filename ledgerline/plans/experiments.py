"""Experiment analysis on the event table: arm = user parity, success = purchase, secondary metric = value."""

from __future__ import annotations

import statistics

from pyspark.sql import functions as F

from ..functions.tails import erfc_sql
from ..operators import experiment as X
from .registry import query
from .series import rnd

c = F.col
INV = statistics.NormalDist().inv_cdf

ARMS = """
days AS (SELECT CAST(user_id % 2 AS INTEGER) AS arm, CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS x FROM events GROUP BY 1, 2),
arms AS (SELECT CAST(sum(n) FILTER (WHERE arm = 0) AS BIGINT) AS na, CAST(sum(x) FILTER (WHERE arm = 0) AS BIGINT) AS xa,
    CAST(sum(n) FILTER (WHERE arm = 1) AS BIGINT) AS nb, CAST(sum(x) FILTER (WHERE arm = 1) AS BIGINT) AS xb FROM days)
"""


def arm():
    return (c("user_id") % 2).cast("int")


def days(t):
    return X.arm_days(t.events, arm(), c("ts").cast("date"), c("event_type") == "purchase")


def baselines(t):
    """Purchase rate per user group."""
    return t.events.groupBy((c("user_id") % 5).cast("int").alias("segment")).agg(
        F.avg((c("event_type") == "purchase").cast("double")).alias("baseline"))


BASELINE_SQL = "SELECT CAST(user_id % 5 AS INTEGER) AS segment, avg(CAST(event_type = 'purchase' AS INTEGER)) AS baseline FROM events GROUP BY 1"
H_SQL = "2 * (asin(sqrt(baseline + 0.01)) - asin(sqrt(baseline)))"


@query("sample_size", f"""SELECT segment, round(baseline, 6) AS baseline, round({H_SQL}, 6) AS effect,
 CAST(ceil(2 * power({INV(0.975) + INV(0.8)!r} / ({H_SQL}), 2)) AS BIGINT) AS n_per_arm FROM ({BASELINE_SQL})""")
def sample_size(t):
    return rnd(X.sample_size(baselines(t), "baseline", 0.01))


@query("power_curve", f"""WITH d AS (SELECT segment, baseline, ceil(2 * power({INV(0.975) + INV(0.8)!r} / ({H_SQL}), 2)) AS n FROM ({BASELINE_SQL})),
g AS (SELECT segment, lift, abs(2 * (asin(sqrt(baseline + lift)) - asin(sqrt(baseline)))) * sqrt(n / 2.0) AS s FROM d, (SELECT unnest([{', '.join(repr(0.002 + 0.018 * i / 39) for i in range(40))}])::DOUBLE AS lift))
SELECT segment, round(lift, 6) AS lift, round(0.5 * {erfc_sql(f'(-(s - {INV(0.975)!r}) / sqrt(2.0))')} + 0.5 * {erfc_sql(f'(-(-s - {INV(0.975)!r}) / sqrt(2.0))')}, 5) AS power FROM g""")
def power_curve(t):
    lifts = [0.002 + 0.018 * i / 39 for i in range(40)]
    designs = X.sample_size(baselines(t), "baseline", 0.01)
    curve = X.power_curve(designs, "baseline", "n_per_arm", lifts)
    return curve.select("segment", F.round("lift", 6).alias("lift"), F.round("power", 5).alias("power"))


@query("srm_check", f"""WITH {ARMS}, s AS (SELECT na, nb, 2 * power(na - (na + nb) / 2.0, 2) / ((na + nb) / 2.0) AS chi2 FROM arms)
SELECT na, nb, round(chi2, 6) AS chi2, round({erfc_sql('sqrt(chi2 / 2.0)')}, 6) AS p FROM s""")
def srm_check(t):
    return rnd(X.srm_check(days(t)))


Z_SQL = "(CAST(xb AS DOUBLE) / nb - CAST(xa AS DOUBLE) / na) / sqrt((CAST(xa + xb AS DOUBLE) / (na + nb)) * (1 - CAST(xa + xb AS DOUBLE) / (na + nb)) * (1.0::DOUBLE / na + 1.0::DOUBLE / nb))"


@query("ab_ztest", f"""WITH {ARMS}, z AS (SELECT *, {Z_SQL} AS z, CAST(xa AS DOUBLE) / na AS pa, CAST(xb AS DOUBLE) / nb AS pb FROM arms),
h AS (SELECT *, {INV(0.975)!r} * sqrt(pa * (1 - pa) / na + pb * (1 - pb) / nb) AS half FROM z)
SELECT na, xa, nb, xb, round(z, 6) AS z, round(0.5 * {erfc_sql('(z / sqrt(2.0))')}, 6) AS p, round(pb - pa, 6) AS lift, round(pb - pa - half, 6) AS ci_low,
 round(pb - pa + half, 6) AS ci_high, round(2 * (asin(sqrt(pb)) - asin(sqrt(pa))), 6) AS cohen_h FROM h""")
def ab_ztest(t):
    return rnd(X.compare_proportions(X.two_arms(days(t))))


WELCH_SQL = """WITH s AS (SELECT count(value) FILTER (WHERE user_id % 2 = 0) AS n0, avg(value) FILTER (WHERE user_id % 2 = 0) AS m0, var_samp(value) FILTER (WHERE user_id % 2 = 0) AS v0,
 count(value) FILTER (WHERE user_id % 2 = 1) AS n1, avg(value) FILTER (WHERE user_id % 2 = 1) AS m1, var_samp(value) FILTER (WHERE user_id % 2 = 1) AS v1 FROM events)
SELECT round((m1 - m0) / sqrt(v0 / n0 + v1 / n1), 6) AS t, round(power(v0 / n0 + v1 / n1, 2) / (power(v0 / n0, 2) / (n0 - 1) + power(v1 / n1, 2) / (n1 - 1)), 4) AS df FROM s"""


@query("welch_t", WELCH_SQL)
def welch_t(t):
    return X.welch(t.events, arm(), "value").select(F.round("t", 6).alias("t"), F.round("df", 4).alias("df"))


@query("welch_p")
def welch_p(t):
    """The same test with its two-sided p."""
    return X.welch(t.events, arm(), "value")


@query("cumulative_arms", f"""WITH {ARMS} SELECT arm, CAST(day AS VARCHAR) AS day, CAST(sum(n) OVER w AS BIGINT) AS n_cum, CAST(sum(x) OVER w AS BIGINT) AS x_cum FROM days
 WINDOW w AS (PARTITION BY arm ORDER BY day ROWS UNBOUNDED PRECEDING)""")
def cumulative_arms(t):
    return X.cumulative_arms(days(t))


@query("daily_z", f"""WITH {ARMS}, w AS (SELECT day, sum(n) FILTER (WHERE arm = 0) AS n0, sum(x) FILTER (WHERE arm = 0) AS x0, sum(n) FILTER (WHERE arm = 1) AS n1, sum(x) FILTER (WHERE arm = 1) AS x1 FROM days GROUP BY 1),
k AS (SELECT day, CAST(sum(n0) OVER o AS BIGINT) AS na, CAST(sum(x0) OVER o AS BIGINT) AS xa, CAST(sum(n1) OVER o AS BIGINT) AS nb, CAST(sum(x1) OVER o AS BIGINT) AS xb FROM w WINDOW o AS (ORDER BY day ROWS UNBOUNDED PRECEDING)),
z AS (SELECT *, {Z_SQL} AS z FROM k)
SELECT CAST(day AS VARCHAR) AS day, na AS n0, xa AS x0, nb AS n1, xb AS x1, round(z, 6) AS z, round(0.5 * {erfc_sql('(z / sqrt(2.0))')}, 6) AS p FROM z""")
def daily_z(t):
    return rnd(X.daily_z(days(t)))


@query("aa_replay")
def aa_replay(t):
    per_user = t.events.groupBy("user_id", c("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(c("event_type") == "purchase").alias("x"))
    return X.aa_replay(per_user, "user_id", "day", "n", "x", replays=2000)


def posterior_sql(grid):
    """The mass of both posteriors on a grid; ``w`` has i, p, step, wa, wb."""
    return f"""{ARMS}, q AS (SELECT xa + 1.0::DOUBLE AS a1, na - xa + 1.0::DOUBLE AS b1, xb + 1.0::DOUBLE AS a2, nb - xb + 1.0::DOUBLE AS b2 FROM arms),
m AS (SELECT *, a1 / (a1 + b1) AS m1, sqrt(a1 * b1 / ((a1 + b1) * (a1 + b1) * (a1 + b1 + 1))) AS s1, a2 / (a2 + b2) AS m2, sqrt(a2 * b2 / ((a2 + b2) * (a2 + b2) * (a2 + b2 + 1))) AS s2 FROM q),
g AS (SELECT *, greatest(least(m1 - 8 * s1, m2 - 8 * s2), 0.0) AS lo, least(greatest(m1 + 8 * s1, m2 + 8 * s2), 1.0) AS hi FROM m),
pts AS (SELECT i, a1, b1, a2, b2, (hi - lo) / {grid} AS step, lo + (hi - lo) * (i + 0.5) / {grid} AS p FROM g, (SELECT unnest(range({grid})) AS i)),
lg AS (SELECT i, p, step, (a1 - 1) * ln(p) + (b1 - 1) * ln(1 - p) AS la, (a2 - 1) * ln(p) + (b2 - 1) * ln(1 - p) AS lb FROM pts),
d AS (SELECT i, p, step, exp(la - max(la) OVER ()) AS da, exp(lb - max(lb) OVER ()) AS db FROM lg),
w AS (SELECT i, p, step, da / sum(da) OVER () AS wa, db / sum(db) OVER () AS wb FROM d)"""


@query("bayes_ab", f"""WITH {posterior_sql(X.GRID)},
cu AS (SELECT p, wa, wb, COALESCE(sum(wa) OVER o, 0) AS ca, COALESCE(sum(wb) OVER o, 0) AS cb, COALESCE(sum(wb * p) OVER o, 0) AS mb FROM w WINDOW o AS (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT round(sum(wb * (ca + wa / 2)), 6) AS p_b_beats_a, round(sum(wa * (p * cb - mb)), 6) AS expected_loss FROM cu""")
def bayes_ab(t):
    return rnd(X.bayes_compare(X.two_arms(days(t))))


@query("bayes_lift_ci", f"""WITH {posterior_sql(X.LIFT_GRID)},
e AS (SELECT b.i - a.i AS d, sum(a.wa * b.wb) AS m, max(a.step) AS step FROM w a, w b GROUP BY 1),
cu AS (SELECT d, m, step, sum(m) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS c FROM e)
SELECT round(sum(m * d * step), 6) AS mean_lift, round(max(step * (d - 0.5 + (0.025 - (c - m)) / m)) FILTER (c >= 0.025 AND c - m < 0.025), 6) AS low,
 round(max(step * (d - 0.5 + (0.975 - (c - m)) / m)) FILTER (c >= 0.975 AND c - m < 0.975), 6) AS high FROM cu""")
def bayes_lift_ci(t):
    return rnd(X.bayes_lift_interval(X.two_arms(days(t))))
