"""Two-arm experiments: design, allocation check, frequentist and Bayesian comparison, A/A replay."""

from __future__ import annotations

import statistics
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tails import chi2_sf, normal_cdf, normal_sf, t_p_value

INV = statistics.NormalDist().inv_cdf
#: Cells of the posterior grids: one posterior against a point, and one against the other.
GRID, LIFT_GRID = 20000, 1000


def effect_size(p2: Column, p1: Column) -> Column:
    """Cohen's h."""
    return 2 * (F.asin(F.sqrt(p2)) - F.asin(F.sqrt(p1)))


def sample_size(baselines: DataFrame, rate: str, lift: float, alpha: float = 0.05, power: float = 0.8) -> DataFrame:
    """Adds ``effect`` and ``n_per_arm`` for a two-sided test of the given absolute lift."""
    z = INV(1 - alpha / 2) + INV(power)
    h = effect_size(F.col(rate) + lift, F.col(rate))
    return baselines.withColumn("effect", h).withColumn(
        "n_per_arm", F.ceil(2 * F.pow(F.try_divide(F.lit(z), h), F.lit(2.0))).cast("bigint")
    )


def power_curve(designs: DataFrame, rate: str, n: str, lifts: list[float], alpha: float = 0.05) -> DataFrame:
    """Power of each design at each candidate lift, both rejection regions counted."""
    grid = designs.select("*", F.explode(F.array(*[F.lit(float(x)) for x in lifts])).alias("lift"))
    shift = F.abs(effect_size(F.col(rate) + F.col("lift"), F.col(rate))) * F.sqrt(F.col(n) / 2.0)
    z = INV(1 - alpha / 2)
    return grid.withColumn("power", normal_cdf(shift - z) + normal_cdf(-shift - z))


def arm_days(events: DataFrame, arm: Column, day: Column, success: Column) -> DataFrame:
    """``arm, day, n, x``: everything below works on these few rows."""
    return events.groupBy(arm.alias("arm"), day.alias("day")).agg(F.count(F.lit(1)).alias("n"), F.count_if(success).alias("x"))


def two_arms(days: DataFrame) -> DataFrame:
    """One row ``na, xa, nb, xb`` from arm rows (arm 0 is A, arm 1 is B)."""
    def total(v: str, arm: int) -> Column:
        return F.sum(F.when(F.col("arm") == arm, F.col(v)).otherwise(0))

    return days.agg(total("n", 0).alias("na"), total("x", 0).alias("xa"), total("n", 1).alias("nb"), total("x", 1).alias("xb"))


def srm_check(days: DataFrame) -> DataFrame:
    """Is the split what an even allocation would give?"""
    half = (F.col("na") + F.col("nb")) / 2.0
    chi2 = (F.pow(F.col("na") - half, F.lit(2.0)) + F.pow(F.col("nb") - half, F.lit(2.0))) / half
    return two_arms(days).select("na", "nb", chi2.alias("chi2"), chi2_sf(chi2, 1).alias("p"))


def pooled_z(xa: Column, na: Column, xb: Column, nb: Column) -> Column:
    pool = F.try_divide((xa + xb).cast("double"), na + nb)
    se = F.sqrt(pool * (1 - pool) * (F.try_divide(F.lit(1.0), na) + F.try_divide(F.lit(1.0), nb)))
    return F.try_divide(F.try_divide(xb.cast("double"), nb) - F.try_divide(xa.cast("double"), na), se)


def compare_proportions(arms: DataFrame, level: float = 0.95) -> DataFrame:
    """Pooled z with one-sided p (B larger), absolute lift with its Wald interval, Cohen's h."""
    na, xa, nb, xb = (F.col(v) for v in ("na", "xa", "nb", "xb"))
    pa, pb = xa / na.cast("double"), xb / nb.cast("double")
    z = pooled_z(xa, na, xb, nb)
    half = INV(0.5 + level / 2) * F.sqrt(pa * (1 - pa) / na + pb * (1 - pb) / nb)
    return arms.select("na", "xa", "nb", "xb", z.alias("z"), normal_sf(z).alias("p"), (pb - pa).alias("lift"),
                       (pb - pa - half).alias("ci_low"), (pb - pa + half).alias("ci_high"), effect_size(pb, pa).alias("cohen_h"))


def welch(df: DataFrame, arm: Column, value: str) -> DataFrame:
    """Unequal-variance t test of B against A; one pass of partial sums, the tail on the single result row."""
    parts = df.select(arm.alias("arm"), F.col(value).alias("v")).groupBy("arm").agg(
        F.count("v").alias("n"), F.avg("v").alias("m"), F.var_samp("v").alias("s2"))
    one = parts.agg(*[F.max(F.when(F.col("arm") == k, F.col(c))).alias(f"{c}{k}") for k in (0, 1) for c in ("n", "m", "s2")])
    va, vb = F.col("s20") / F.col("n0"), F.col("s21") / F.col("n1")
    t = F.try_divide(F.col("m1") - F.col("m0"), F.sqrt(va + vb))
    freedom = F.try_divide(F.pow(va + vb, F.lit(2.0)), va * va / (F.col("n0") - 1) + vb * vb / (F.col("n1") - 1))
    return one.select(t.alias("t"), freedom.alias("df")).withColumn("p", t_p_value("t", "df"))


def cumulative_arms(days: DataFrame) -> DataFrame:
    """Running counts per arm and day."""
    w = Window.partitionBy("arm").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return days.select("arm", "day", F.sum("n").over(w).alias("n_cum"), F.sum("x").over(w).alias("x_cum"))


def daily_z(days: DataFrame) -> DataFrame:
    """The test as it would have read after every day."""
    wide = days.groupBy("day").agg(*[
        F.sum(F.when(F.col("arm") == k, F.col(v)).otherwise(0)).alias(f"{v}{k}") for k in (0, 1) for v in ("n", "x")])
    # One row per day: bounded by the calendar.
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    cum = wide.select("day", *[F.sum(v).over(w).alias(v) for v in ("n0", "x0", "n1", "x1")])
    z = pooled_z(F.col("x0"), F.col("n0"), F.col("x1"), F.col("n1"))
    return cum.withColumn("z", z).withColumn("p", normal_sf(F.col("z")))


def sides(h: np.ndarray, replays: int) -> np.ndarray:
    """The arm (0 or 1) of each user hash in every replay: the bits of as many splitmix numbers as it takes."""
    words = -(-replays // 64)
    with np.errstate(over="ignore"):
        z = h.view(np.uint64)[:, None] + np.arange(1, words + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return np.unpackbits(z.view(np.uint8).reshape(len(h), -1), axis=1)[:, :replays]


def replay_sums(user_days: DataFrame, user: str, day: str, n: str, x: str, replays: int, salt: int) -> DataFrame:
    """``replay, day, n_0, x_0, n_1, x_1``: one pass that adds every batch into a (day x replay) array per task.

    A task holds 2 x ``replays`` numbers per day it meets and hands out as many rows; no row of the data is copied.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        kind = None
        for batch in batches:
            kind = batch.column(1).type
            h, days = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist(), dtype=object)
            values = np.column_stack([batch.column(2).to_numpy(), batch.column(3).to_numpy()]).astype(float)
            for at in range(0, len(h), 1024):
                part = slice(at, at + 1024)
                arm = sides(h[part], replays).astype(float)
                own, place = np.unique(days[part], return_inverse=True)
                for i, one in enumerate(own):
                    rows = place == i
                    held = seen.setdefault(one, [np.zeros((replays, 2)), np.zeros(2)])
                    held[0] += arm[rows].T @ values[part][rows]
                    held[1] += values[part][rows].sum(axis=0)
        for one, (second, whole) in sorted(seen.items()):
            first = whole[None, :] - second
            columns = [np.arange(1, replays + 1), *[side[:, i].astype(np.int64) for side in (first, second) for i in (0, 1)]]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array([one] * replays, kind), *[pa.array(c) for c in columns[1:]]],
                                             names=["replay", "day", "n_0", "x_0", "n_1", "x_1"])

    source = user_days.select(F.xxhash64(F.lit(salt), user).alias("h"), F.col(day).alias("day"), F.col(n).cast("long"), F.col(x).cast("long"))
    kind = user_days.schema[day].dataType.simpleString()
    parts = source.filter("day is not null").mapInArrow(add, f"replay long, day {kind}, n_0 long, x_0 long, n_1 long, x_1 long")
    return parts.groupBy("replay", "day").agg(*[F.sum(v).alias(v) for v in ("n_0", "x_0", "n_1", "x_1")])


def aa_replay(user_days: DataFrame, user: str, day: str, n: str, x: str, replays: int = 2000, alpha: float = 0.05,
              salt: int = 7) -> DataFrame:
    """False-positive rate of daily looks against one final look, by re-randomising real users.

    Each replay splits users by a salted hash, so there is no true effect.  ``user_days`` has one row per user and day.
    """
    sums = replay_sums(user_days, user, day, n, x, replays, salt)
    w = Window.partitionBy("replay").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    cum = sums.select("replay", "day", *[F.sum(v).over(w).alias(v) for v in ("n_0", "x_0", "n_1", "x_1")])
    z = F.abs(pooled_z(F.col("x_0"), F.col("n_0"), F.col("x_1"), F.col("n_1")))
    critical = INV(1 - alpha / 2)
    runs = cum.withColumn("_z", z).groupBy("replay").agg(F.max("_z").alias("any_look"), F.max_by("_z", "day").alias("last_look"))
    return runs.agg(
        F.count(F.lit(1)).alias("replays"),
        F.avg((F.coalesce("any_look", F.lit(0.0)) > critical).cast("double")).alias("fpr_peeking"),
        F.avg((F.coalesce("last_look", F.lit(0.0)) > critical).cast("double")).alias("fpr_fixed"),
    )


def posterior_grid(arms: DataFrame, prior_a: float, prior_b: float, grid: int) -> DataFrame:
    """``i, p, step, wa, wb``: the mass of both posteriors in ``grid`` equal cells, eight deviations around both means."""
    na, xa, nb, xb = (F.col(v) for v in ("na", "xa", "nb", "xb"))
    a1, b1 = xa + prior_a, na - xa + prior_b
    a2, b2 = xb + prior_a, nb - xb + prior_b

    def mean(a, b):
        return a / (a + b)

    def sd(a, b):
        return F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))

    low = F.greatest(F.least(mean(a1, b1) - 8 * sd(a1, b1), mean(a2, b2) - 8 * sd(a2, b2)), F.lit(0.0))
    high = F.least(F.greatest(mean(a1, b1) + 8 * sd(a1, b1), mean(a2, b2) + 8 * sd(a2, b2)), F.lit(1.0))
    points = arms.withColumn("lo", low).withColumn("step", (high - F.col("lo")) / grid).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    points = points.withColumn("p", F.col("lo") + F.col("step") * (F.col("i") + 0.5))
    log_a = (a1 - 1) * F.log("p") + (b1 - 1) * F.log1p(-F.col("p"))
    log_b = (a2 - 1) * F.log("p") + (b2 - 1) * F.log1p(-F.col("p"))
    # The grid is a constant number of rows, so whole-frame windows are bounded.
    everything = Window.partitionBy()
    dens = points.select("i", "p", "step", log_a.alias("la"), log_b.alias("lb")).select(
        "i", "p", "step", F.exp(F.col("la") - F.max("la").over(everything)).alias("da"), F.exp(F.col("lb") - F.max("lb").over(everything)).alias("db"))
    return dens.select("i", "p", "step", (F.col("da") / F.sum("da").over(everything)).alias("wa"), (F.col("db") / F.sum("db").over(everything)).alias("wb"))


def bayes_compare(arms: DataFrame, prior_a: float = 1.0, prior_b: float = 1.0, grid: int = GRID) -> DataFrame:
    """P(B > A) and the expected loss of choosing B, by integration on a grid around both posteriors.

    The grid spans eight posterior deviations around both means, so it stays
    fine however many observations there are; its size is fixed.
    """
    mass = posterior_grid(arms, prior_a, prior_b, grid)
    below = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    cum = mass.select(
        "p", "wa", "wb", F.coalesce(F.sum("wa").over(below), F.lit(0.0)).alias("ca"), F.coalesce(F.sum("wb").over(below), F.lit(0.0)).alias("cb"),
        F.coalesce(F.sum(F.col("wb") * F.col("p")).over(below), F.lit(0.0)).alias("mb"))
    return cum.agg(F.sum(F.col("wb") * (F.col("ca") + F.col("wa") / 2)).alias("p_b_beats_a"),
                   F.sum(F.col("wa") * (F.col("p") * F.col("cb") - F.col("mb"))).alias("expected_loss"))


def bayes_lift_interval(arms: DataFrame, prior_a: float = 1.0, prior_b: float = 1.0, level: float = 0.95, grid: int = LIFT_GRID) -> DataFrame:
    """``mean_lift, low, high``: posterior mean and credible interval of B - A.

    Both posteriors lie on one grid, so their difference falls on multiples of its step: the mass of each is one posterior
    summed against the other, shifted.  The cumulated mass is interpolated at the two tails.  The work is the counting
    of the arms; the grid has a fixed size.
    """
    mass = posterior_grid(arms, prior_a, prior_b, grid)
    # One row with the second posterior as an array; every cell of the first meets it.
    second = mass.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "wb"))), lambda r: r["wb"]).alias("b"))
    shifted = mass.select("i", "step", "wa").join(F.broadcast(second)).select("i", "step", "wa", F.posexplode("b").alias("j", "wb"))
    diff = shifted.groupBy((F.col("j") - F.col("i")).alias("d")).agg(F.sum(F.col("wa") * F.col("wb")).alias("m"), F.max("step").alias("step"))
    upto = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    cum = diff.select("d", "m", "step", F.sum("m").over(upto).alias("c"))

    def at(share: float) -> Column:
        # The mass of a multiple is spread evenly over one step around it.
        inside = (F.col("c") >= share) & (F.col("c") - F.col("m") < share)
        return F.max(F.when(inside, F.col("step") * (F.col("d") - 0.5 + (F.lit(share) - (F.col("c") - F.col("m"))) / F.col("m"))))

    tail = (1 - level) / 2
    return cum.agg(F.sum(F.col("m") * F.col("d") * F.col("step")).alias("mean_lift"), at(tail).alias("low"), at(1 - tail).alias("high"))
