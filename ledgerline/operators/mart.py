"""Star-schema mart: typed facts, a conformed dimension, load counts and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import placeholder_to_null
from ..sources.files import write_parquet
from .gates import count_checks, duplicate_keys, one_check, orphan_count
from .joins import lookup_join
from .ordered import global_number

# Codes of country groups that the annual source mixes with countries.
AGGREGATE_CODES = (
    "WLD", "EUU", "OED", "HIC", "LIC", "LMC", "UMC", "MIC", "EAS", "ECS", "LCN", "MEA", "NAC", "SAS", "SSF", "ARB",
    "CEB", "EAP", "ECA", "EMU", "FCS", "HPC", "IBD", "IBT", "IDA", "IDB", "IDX", "LAC", "LDC", "LMY", "LTE", "MNA",
    "OSS", "PRE", "PSS", "PST", "SSA", "SST", "TEA", "TEC", "TLA", "TMN", "TSA", "TSS", "EAR", "AFE", "AFW",
)


def annual_fact(df: DataFrame, value: str, aggregates: tuple[str, ...] | None = AGGREGATE_CODES,
                positive: bool = True) -> DataFrame:
    """Typed annual observations of ``(country, country_code, year, value)``; missing values are dropped.

    With ``positive`` non-positive values go too; without it extremes are kept.
    ``aggregates`` adds the flag for groups of countries.
    """
    out = df.select("country", "country_code", F.col("year").cast("int"), F.col(value).cast("double")).dropna(
        subset=[value]
    )
    if positive:
        out = out.filter(F.col(value) > 0)
    if aggregates is not None:
        out = out.withColumn("is_aggregate", F.col("country_code").isin(*aggregates))
    return out


def monthly_fact(df: DataFrame, series: str = "series_id", price: str = "price",
                 placeholders: tuple[str, ...] = ("cpi", "real_price", "pe10")) -> DataFrame:
    """Monthly prices with 0 placeholders as NULL, the period return, and the year.

    One row per series and month, so a series' window holds no more rows than there are months.
    """
    order = Window.partitionBy(series).orderBy("month")
    cleaned = df.select(
        series, "month", price, *[placeholder_to_null(c).alias(c) for c in placeholders if c in df.columns]
    )
    change = F.try_divide(F.col(price), F.lag(price).over(order)) - 1
    return cleaned.withColumn("monthly_return", change).withColumn("year", F.year("month")).dropna(subset=[price])


def conform_dimension(sources: list[DataFrame], code: str = "country_code", attrs: tuple[str, ...] = ("country",),
                      flag: str = "is_aggregate", key: str = "country_key") -> DataFrame:
    """One row per natural code over several sources, earlier sources winning, with a dense surrogate key.

    Keys run in order of (first source, code).  A source without the flag counts as False.
    """
    parts = []
    for rank, src in enumerate(sources):
        flagged = F.col(flag) if flag in src.columns else F.lit(False)
        parts.append(src.select(F.lit(rank).alias("_rank"), code, *attrs, flagged.alias(flag)))
    stacked = reduce(DataFrame.unionByName, parts)
    winner = stacked.groupBy(code).agg(F.min(F.struct("_rank", *attrs, flag)).alias("_w"))
    flat = winner.select(F.col("_w._rank").alias("_rank"), code, *[F.col(f"_w.{a}").alias(a) for a in attrs],
                         F.col(f"_w.{flag}").alias(flag))
    return global_number(flat, ["_rank", code], key).select(
        F.col(key).cast("int").alias(key), *attrs, code, flag
    )


def key_fact(fact: DataFrame, dim: DataFrame, value: str, code: str = "country_code", key: str = "country_key",
             period: str = "year") -> DataFrame:
    """Replace the natural code by its surrogate key and keep one row per (key, period), the smallest value's."""
    keyed = lookup_join(fact, dim.select(code, key), code, "left")
    return keyed.groupBy(key, period).agg(F.min(value).alias(value))


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per loaded table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def load_mart(tables: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Write every table below a fresh root and return the frames read back from there."""
    out = {}
    for name, df in tables.items():
        write_parquet(df, f"{root}/{name}")
        out[name] = df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}")
    return out


def mart_checks(dim: DataFrame, facts: dict[str, DataFrame], annual: str, monthly: DataFrame, price: str,
                years: tuple[int, int], period: str = "period_id", key: str = "country_key",
                max_move: float = 0.6) -> DataFrame:
    """Post-load checks: orphans per fact, year range, positive price, repeated period, implausible return."""
    low, high = years
    parts = [one_check(f"{name} orphaned from dimension", orphan_count(df, dim, key), "check_name", "failing_rows")
             for name, df in facts.items()]
    parts.append(count_checks(facts[annual], {f"{annual} year out of range": (F.col("year") < low) | (F.col("year") > high)},
                              "check_name", "failing_rows"))
    parts.append(count_checks(monthly, {
        "monthly price not positive": F.col(price) <= 0,
        "monthly return implausible": F.abs("monthly_return") > max_move,
    }, "check_name", "failing_rows"))
    parts.append(one_check("monthly period repeated", duplicate_keys(monthly, period), "check_name", "failing_rows"))
    return reduce(DataFrame.unionByName, parts)
