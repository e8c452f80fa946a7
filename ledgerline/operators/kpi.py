"""One-row-per-entity KPIs over relative periods, and the rule-based segments built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import epoch_30d
from ..functions.numbers import ratio
from .gates import count_checks, duplicate_keys, one_check
from .joins import lookup_join
from .ordered import exact_quantiles

DEFEND, GROW, MAINTAIN, MONITOR = "DEFEND (at risk)", "GROW (headroom)", "MAINTAIN (loyal)", "MONITOR (low potential)"


def period_label(month: str | Column, latest: str | Column) -> Column:
    """L3M, P3M, PRIOR or OLD, counted back from the latest month."""
    m = F.col(month) if isinstance(month, str) else month
    mx = F.col(latest) if isinstance(latest, str) else latest
    return (
        F.when(m > F.add_months(mx, -3), "L3M").when(m > F.add_months(mx, -6), "P3M")
        .when(m > F.add_months(mx, -12), "PRIOR").otherwise("OLD")
    )


def with_period(monthly: DataFrame, month: str = "month_start") -> DataFrame:
    """Label each row by its period; the bound is a one-row aggregate, hence safe to broadcast."""
    bound = monthly.agg(F.max(month).alias("_mx"))
    return monthly.join(F.broadcast(bound)).withColumn("win", period_label(month, "_mx")).drop("_mx")


def share_slope(entity: str, market: str, own: str, month: str) -> list[Column]:
    """Monthly slope of own/market on time in units of 30 days, as an aggregate expression."""
    return [F.regr_slope(ratio(own, market), epoch_30d(month)).alias("share_slope_pm")]


def entity_kpis(dim: DataFrame, monthly: DataFrame, calls: DataFrame, entity: str, market: str = "market",
                own: str = "own", month: str = "month_start") -> DataFrame:
    """Volumes, shares, slope, momentum and call intensity, one row per dimension member.

    ``monthly`` has one row per entity and month; ``calls`` one row per entity
    and month with a ``calls`` count.  Both are aggregated before the joins.
    """
    labelled = with_period(monthly, month)
    recent = F.col("win").isin("L3M", "P3M")

    def total(value: str, cond: Column) -> Column:
        return F.sum(F.when(cond, F.col(value)))

    volumes = labelled.groupBy(entity).agg(
        total(market, recent).alias("_market"),
        total(own, recent).alias("_own"),
        ratio(total(own, F.col("win") == "L3M"), total(market, F.col("win") == "L3M")).alias("share_l3m"),
        ratio(total(own, F.col("win") == "P3M"), total(market, F.col("win") == "P3M")).alias("share_p3m"),
        *share_slope(entity, market, own, month),
    )
    last = calls.agg(F.max(month).alias("_mx"))
    effort = (
        calls.join(F.broadcast(last)).filter(F.col(month) > F.add_months("_mx", -6))
        .groupBy(entity).agg(F.sum("calls").alias("_calls"))
    )
    joined = dim.join(volumes, entity, "left").join(effort, entity, "left")
    return joined.select(
        *dim.columns,
        F.coalesce("_market", F.lit(0)).alias("market_l6m"),
        F.coalesce("_own", F.lit(0)).alias("own_l6m"),
        ratio(F.coalesce("_own", F.lit(0)), "_market").alias("own_share_l6m"),
        "share_l3m", "share_p3m", "share_slope_pm",
        (F.col("share_slope_pm") * 3).alias("share_momentum"),
        F.coalesce("_calls", F.lit(0)).alias("calls_l6m"),
        ratio(F.coalesce("_calls", F.lit(0)), "_market").alias("calls_per_market"),
    )


def kpi_checks(kpis: DataFrame, entity: str) -> DataFrame:
    share = F.col("own_share_l6m")
    return one_check("duplicate entities", duplicate_keys(kpis, entity), "chk", "fails").unionByName(
        count_checks(kpis, {"share outside [0,1]": (share < 0) | (share > 1)}, "chk", "fails")
    )


def rule_segments(kpis: DataFrame, value_quantile: float = 0.45, slope_cut: float = 0.004) -> DataFrame:
    """Value x momentum classes: the value cut is an exact quantile over all entities, one row broadcast."""
    cut = exact_quantiles(kpis, "market_l6m", {"_cut": value_quantile})
    high = F.col("market_l6m") >= F.col("_cut")
    slope = F.col("share_slope_pm")
    segment = (
        F.when(high & (slope <= -slope_cut), DEFEND).when(high & (slope >= slope_cut), GROW)
        .when(high, MAINTAIN).otherwise(MONITOR)
    )
    return kpis.join(F.broadcast(cut)).withColumn("segment", segment).drop("_cut")
