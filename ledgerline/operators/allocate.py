"""Capacity allocation by marginal value with diminishing returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import geometric_value
from .kpi import DEFEND, GROW, MAINTAIN, MONITOR
from .ordered import kth_largest, running_totals

# Response per call by segment, decay per further call, cap per entity.
RESPONSE = {DEFEND: 0.55, GROW: 0.45, MAINTAIN: 0.15, MONITOR: 0.05}
DECAY = 0.85
MAX_CALLS = 12


def first_unit_value(segment: str = "segment", volume: str = "market_l6m") -> Column:
    beta: Column | None = None
    for name, value in RESPONSE.items():
        hit = F.col(segment) == name
        beta = F.when(hit, value) if beta is None else beta.when(hit, value)
    return beta * F.sqrt(F.col(volume).cast("double"))


def allocate(df: DataFrame, entity: str, base: str, capacity: int, decay: float = DECAY, cap: int = MAX_CALLS,
             name: str = "units_optimized") -> DataFrame:
    """Give ``capacity`` units, each to the entity where it adds most; at most ``cap`` per entity.

    Unit k of an entity adds ``base * decay**k``, so the best plan takes the
    ``capacity`` largest such values.  Only the cut-off value is looked up (a
    distributed rank search); units above it are taken, and units exactly at it
    go to the smallest entity ids until the capacity is used up.  Values are
    compared at nine digits.  Capacity beyond ``cap`` per entity stays unused.
    """
    marginal = F.round(F.col(base) * F.pow(F.lit(float(decay)), F.col("_k").cast("double")), 9)
    units = df.select(F.col(entity), F.col(base), F.explode(F.sequence(F.lit(0), F.lit(cap - 1))).alias("_k")).select(
        entity, marginal.alias("_m")
    )
    n = df.count()
    capacity = min(capacity, n * cap)
    if capacity <= 0:
        return df.withColumn(name, F.lit(0))
    cut = kth_largest(units, "_m", capacity)
    per_entity = units.groupBy(entity).agg(
        F.count_if(F.col("_m") > cut).cast("int").alias("_above"), F.count_if(F.col("_m") == cut).cast("int").alias("_at")
    )
    taken = per_entity.agg(F.sum("_above").alias("s")).first()["s"]
    tied = running_totals(per_entity.filter("_at > 0"), entity, {"_upto": "_at"})
    left = capacity - taken
    extra = F.greatest(F.lit(0), F.least(F.col("_at").cast("bigint"), F.lit(left) - (F.col("_upto") - F.col("_at"))))
    share = per_entity.join(tied.select(entity, extra.alias("_extra")), entity, "left")
    return df.join(
        share.select(entity, (F.col("_above") + F.coalesce("_extra", F.lit(0))).cast("int").alias(name)), entity
    )


def allocation_value(plan: DataFrame, base: str, now: str, optimized: str, decay: float = DECAY,
                     cap: int = MAX_CALLS) -> DataFrame:
    """Expected value today (units clipped at the cap) and under the plan, the uplift, and unused capacity."""
    current = geometric_value(base, F.least(F.col(now), F.lit(cap)).cast("double"), decay)
    planned = geometric_value(base, F.col(optimized).cast("double"), decay)
    sums = plan.agg(
        F.sum(current).alias("ev_current"), F.sum(planned).alias("ev_optimized"),
        (F.sum(now) - F.sum(optimized)).cast("bigint").alias("unused_capacity"),
    )
    return sums.withColumn("uplift", F.try_divide(F.col("ev_optimized"), F.col("ev_current")) - 1)


def coverage(plan: DataFrame, now: str, optimized: str, minimum: int = 4, segments: tuple[str, ...] = (DEFEND, GROW)) -> DataFrame:
    """Share of priority entities that get at least ``minimum`` units, before and after."""
    return plan.filter(F.col("segment").isin(*segments)).agg(
        F.avg((F.col(now) >= minimum).cast("double")).alias("coverage_now"),
        F.avg((F.col(optimized) >= minimum).cast("double")).alias("coverage_opt"),
    )


def segment_table(plan: DataFrame, now: str, optimized: str) -> DataFrame:
    return plan.groupBy("segment").agg(
        F.count(F.lit(1)).alias("entities"), F.sum("market_l6m").alias("market"),
        F.round(F.avg("own_share_l6m"), 6).alias("own_share"), F.sum(now).cast("bigint").alias("calls_now"),
        F.sum(optimized).cast("bigint").alias("calls_opt"),
    )
