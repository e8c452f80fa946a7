"""Entity x month panel: age since launch and leakage-safe lag features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import months_between_starts


def with_launch_age(panel: DataFrame, product: str, month: str = "month_start") -> DataFrame:
    """Months since the product's first month, and the month of year.

    The first month is a map-side combined minimum joined back, so that a
    product holding most of the panel is not gathered in one window.
    """
    launch = panel.groupBy(product).agg(F.min(month).alias("_launch"))
    return (
        panel.join(launch, product)
        .withColumn("months_since_launch", months_between_starts(month, "_launch"))
        .withColumn("month_of_year", F.month(month))
        .drop("_launch")
    )


def lag_features(panel: DataFrame, entity: list[str], month: str, demand: str, driver: str) -> DataFrame:
    """Lags 1-3 and 3-row mean of demand, lags 1-2 of the driver, next row's demand as target.

    All values come from one window per entity (one row per month, so bounded
    by the calendar).  Lags are by row: densify first if months may be missing.
    Rows without full history or without a target are dropped.
    """
    w = Window.partitionBy(*entity).orderBy(month)
    out = panel.select(
        "*",
        *[F.lag(demand, k).over(w).alias(f"{demand}_lag{k}") for k in (1, 2, 3)],
        F.avg(demand).over(w.rowsBetween(-2, 0)).alias(f"{demand}_ma3"),
        *[F.lag(driver, k).over(w).alias(f"{driver}_lag{k}") for k in (1, 2)],
        F.lead(demand, 1).over(w).alias("target_next"),
    )
    return out.filter(F.col(f"{demand}_lag3").isNotNull() & F.col("target_next").isNotNull())


def densify_months(panel: DataFrame, entity: list[str], month: str, fill: dict[str, float]) -> DataFrame:
    """Insert the missing months between each entity's first and last, with stated fill values."""
    span = panel.groupBy(*entity).agg(F.min(month).alias("_a"), F.max(month).alias("_z"))
    grid = span.select(*entity, F.explode(F.sequence("_a", "_z", F.expr("interval 1 month"))).alias(month))
    return grid.join(panel, entity + [month], "left").fillna(fill)


def split_by_date(df: DataFrame, month: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the date, rows from the date on."""
    at = F.lit(cut).cast("date")
    return df.filter(F.col(month) < at), df.filter(F.col(month) >= at)
