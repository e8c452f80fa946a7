"""KPIs, allocation, mart, panel and experiments."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import allocate as A
from ledgerline.operators import experiment as X
from ledgerline.operators import kpi as K
from ledgerline.operators import mart as M
from ledgerline.operators import panel as N


def greedy(base, capacity, decay=0.85, cap=12):
    plan = np.zeros(len(base), dtype=int)
    for _ in range(min(capacity, cap * len(base))):
        value = np.where(plan < cap, np.round(base * decay**plan, 9), -1.0)
        plan[int(np.argmax(value))] += 1
    return plan.tolist()


@pytest.mark.parametrize("capacity,ties", [(0, False), (37, False), (200, True), (10_000, True)])
def test_allocation_is_the_greedy_plan(spark, capacity, ties):
    rng = np.random.default_rng(5)
    base = np.repeat([2.0, 1.0, 0.5], 10) if ties else rng.uniform(0, 5, 30)
    df = spark.createDataFrame([(i, float(b)) for i, b in enumerate(base)], "entity_id int, base double")
    got = [r.units_optimized for r in A.allocate(df, "entity_id", "base", capacity).orderBy("entity_id").collect()]
    assert got == greedy(base, capacity)


def test_allocation_value_and_unused(spark):
    df = spark.createDataFrame([(1, 2.0, 20, 12)], "entity_id int, base double, calls_l6m int, units_optimized int")
    r = A.allocation_value(df, "base", "calls_l6m", "units_optimized").first()
    assert r.uplift == pytest.approx(0) and r.unused_capacity == 8
    assert r.ev_current == pytest.approx(2 * (1 - 0.85**12) / 0.15)


def test_period_labels(spark):
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2025-02-01', interval 1 month)) month_start")
    got = {r.month_start.isoformat()[:7]: r.win for r in K.with_period(df).collect()}
    assert got["2025-02"] == got["2024-12"] == "L3M" and got["2024-11"] == got["2024-09"] == "P3M"
    assert got["2024-08"] == "PRIOR" and got["2024-03"] == "PRIOR" and got["2024-02"] == "OLD"


def test_kpis_of_entities_without_facts(spark):
    dim = spark.createDataFrame([(1,), (2,)], "e int")
    monthly = spark.createDataFrame([(1, "2025-01-01", 4, 1), (1, "2025-02-01", 4, 2)], "e int, m string, market int, own int").select("e", F.to_date("m").alias("month_start"), "market", "own")
    calls = spark.createDataFrame([(1, "2025-02-01", 3)], "e int, m string, calls int").select("e", F.to_date("m").alias("month_start"), "calls")
    got = {r.e: r for r in K.entity_kpis(dim, monthly, calls, "e").collect()}
    assert (got[2].market_l6m, got[2].own_share_l6m, got[2].calls_l6m) == (0, None, 0)
    assert got[1].own_share_l6m == pytest.approx(3 / 8) and got[1].share_slope_pm == pytest.approx(0.25 / (31 / 30))


def test_dimension_first_source_wins(spark):
    a = spark.createDataFrame([("Bee", "B", True), ("Aye", "A", False)], "country string, country_code string, is_aggregate boolean")
    b = spark.createDataFrame([("Aye other", "A"), ("Sea", "C")], "country string, country_code string")
    got = [tuple(r) for r in M.conform_dimension([a, b]).orderBy("country_key").collect()]
    assert got == [(1, "Aye", "A", False), (2, "Bee", "B", True), (3, "Sea", "C", False)]


def test_lags_need_dense_months(spark):
    rows = [("a", f"2024-{m:02d}-01", m, float(m)) for m in (1, 2, 4, 5, 6, 7)]
    panel = spark.createDataFrame(rows, "e string, m string, demand int, driver double").select("e", F.to_date("m").alias("month_start"), "demand", "driver")
    dense = N.densify_months(panel, ["e"], "month_start", {"demand": 0, "driver": 0.0})
    got = [(r.month_start.month, r.demand_lag1, r.demand_lag3, r.target_next) for r in N.lag_features(dense, ["e"], "month_start", "demand", "driver").orderBy("month_start").collect()]
    assert got == [(4, 0, 1, 5), (5, 4, 2, 6), (6, 5, 0, 7)]


def test_published_sample_size(spark):
    base = spark.createDataFrame([(0.10,)], "rate double")
    assert X.sample_size(base, "rate", 0.01).first().n_per_arm == 14745


def test_published_comparison(spark):
    # Rates of a published two-arm result: 14,756 per arm.
    arms = spark.createDataFrame([(14756, 1461, 14756, 1710)], "na bigint, xa bigint, nb bigint, xb bigint")
    r = X.compare_proportions(arms).first()
    assert r.z == pytest.approx(4.680416, abs=1e-6)
    assert (100 * r.ci_low, 100 * r.ci_high) == (pytest.approx(0.9811, abs=1e-4), pytest.approx(2.3938, abs=1e-4))
    assert r.cohen_h == pytest.approx(0.054529, abs=1e-6)
    b = X.bayes_compare(arms).first()
    assert b.p_b_beats_a == pytest.approx(0.9999986, abs=2e-7) and b.expected_loss == pytest.approx(1.0e-9, rel=0.2)
    lift = X.bayes_lift_interval(arms).first()
    assert lift.low == pytest.approx(0.00981, abs=5e-6) and lift.high == pytest.approx(0.02394, abs=5e-6)


def test_lift_interval_against_draws(spark):
    """Skewed posteriors, where no normal approximation holds."""
    for na, xa, nb, xb in ((40, 1, 25, 3), (10, 0, 10, 0), (100, 10, 100, 14), (7, 7, 900, 850)):
        got = X.bayes_lift_interval(spark.createDataFrame([(na, xa, nb, xb)], "na bigint, xa bigint, nb bigint, xb bigint")).first()
        rng = np.random.default_rng(3)
        draws = rng.beta(1 + xb, 1 + nb - xb, 1_000_000) - rng.beta(1 + xa, 1 + na - xa, 1_000_000)
        spread = draws.std()
        assert got.mean_lift == pytest.approx((1 + xb) / (2 + nb) - (1 + xa) / (2 + na), abs=1e-3 * spread)
        assert got.low == pytest.approx(np.quantile(draws, 0.025), abs=0.01 * spread) and got.high == pytest.approx(np.quantile(draws, 0.975), abs=0.01 * spread)


def test_power_at_the_design_point(spark):
    base = X.sample_size(spark.createDataFrame([(0.10,)], "rate double"), "rate", 0.01)
    assert X.power_curve(base, "rate", "n_per_arm", [0.01]).first().power == pytest.approx(0.8, abs=1e-3)


def test_welch(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 50), rng.normal(0.5, 3, 80)
    df = spark.createDataFrame([(0, float(v)) for v in a] + [(1, float(v)) for v in b], "arm int, v double")
    r = X.welch(df, F.col("arm"), "v").first()
    va, vb = a.var(ddof=1) / 50, b.var(ddof=1) / 80
    assert r.t == pytest.approx((b.mean() - a.mean()) / math.sqrt(va + vb))
    assert r.df == pytest.approx((va + vb) ** 2 / (va**2 / 49 + vb**2 / 79))
    assert 0 < r.p < 1


def test_peeking_inflates_false_positives(spark):
    rows = spark.range(2000).select(F.col("id").alias("u"), F.explode(F.sequence(F.lit(1), F.lit(14))).alias("d"))
    rows = rows.withColumn("n", F.lit(1)).withColumn("x", (F.pmod(F.xxhash64("u", "d"), F.lit(10)) == 0).cast("int"))
    r = X.aa_replay(rows, "u", "d", "n", "x", replays=300).first()
    assert r.replays == 300 and 0.01 < r.fpr_fixed < 0.11 and r.fpr_peeking > r.fpr_fixed + 0.05


def test_replay_sums_against_plain_sums(spark):
    rows = [(u, d, (u * d) % 5, (u + d) % 3) for u in range(60) for d in (1, 2, 3) if (u + d) % 4] + [(None, 1, 2, 1), (5, None, 9, 9)]
    df = spark.createDataFrame(rows, "u long, d int, n int, x int").repartition(5)
    got = {(r.replay, r.day): (r.n_0, r.x_0, r.n_1, r.x_1) for r in X.replay_sums(df, "u", "d", "n", "x", 130, 7).collect()}
    hashes = {r.u: r.h for r in df.select("u", F.xxhash64(F.lit(7), "u").alias("h")).collect()}
    arm = {u: X.sides(np.array([h]), 130)[0] for u, h in hashes.items()}
    want = {}
    for u, d, n, x in rows:
        for r in range(130 if d is not None else 0):
            held = want.setdefault((r + 1, d), [0, 0, 0, 0])
            held[2 * arm[u][r]] += n
            held[2 * arm[u][r] + 1] += x
    assert got == {k: tuple(v) for k, v in want.items()}
    # Sides are even and differ between replays.
    share = np.array([arm[u] for u in range(60)]).mean(axis=0)
    assert 0.4 < share.mean() < 0.6 and len({tuple(c) for c in np.array([arm[u] for u in range(60)]).T}) == 130
