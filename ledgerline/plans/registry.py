"""Registered queries: a name, a Spark plan over the source tables and, where SQL can say it, a check query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import SourceRegistry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, so that any client compares the same values."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string").alias(field.name)
        out.append(column)
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with the equivalent SQL if there is one."""

    def register(fn: Callable[[SourceRegistry], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(SourceRegistry(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
