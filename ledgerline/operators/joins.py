"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_BYTES = 64 * 1024 * 1024
#: What a broadcast lookup may take in memory, and the estimate up to which it isn't measured.
SENT_BYTES, SURE_BYTES = 256 * 1024 * 1024, 1024 * 1024
HOT_PARTS = 1000
SALTS = 64


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame: file size for scans, an upper bound for most others."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def held_bytes(df: DataFrame) -> int:
    """About what a frame takes once it is broadcast: rows and lengths of texts are counted.

    Catalyst's estimate goes by compressed files and widths of types, and is as little as a fortieth of it for keys in order.
    """
    texts = [F.coalesce(F.sum(F.octet_length(f"`{f.name}`")), F.lit(0)) for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    n, *lengths = df.agg(F.count(F.lit(1)), *texts).first()
    # A hash table's places and pointers, a row's head, eight bytes per column, its texts; the key is there twice.
    return n * (80 + 8 * len(df.columns)) + 2 * sum(lengths)


def sent(dim: DataFrame) -> bool:
    """Whether a lookup is small enough to be broadcast."""
    planned = planned_bytes(dim)
    return planned <= SMALL_BYTES and (planned <= SURE_BYTES or held_bytes(dim) <= SENT_BYTES)


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a small scan over all cores before expensive row work.

    A small file is often one unsplittable block read by a single task.  Frames
    above ``SMALL_BYTES`` have blocks enough and are returned unshuffled.  The keys
    should identify a row: rows are placed by their hash, the same way on a retry.
    """
    if planned_bytes(df) > SMALL_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *keys)


def hot_keys(fact: DataFrame, keys: list[str], parts: int = HOT_PARTS) -> DataFrame:
    """Keys holding at least 1/parts of the rows.  There can be no more than ``parts`` of them."""
    counts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    return counts.join(F.broadcast(total)).filter(F.col("_n") * parts >= F.col("_total")).select(*keys)


def salted_join(fact: DataFrame, dim: DataFrame, keys: list[str], hot: DataFrame, how: str = "inner",
                salts: int = SALTS, strategy: str | None = None) -> DataFrame:
    """Shuffled join in which the rows of hot keys are spread over ``salts`` partitions.  ``strategy`` is a hint for Spark.

    ``hot`` lists the hot keys and must be bounded by construction; only the
    lookup rows of those keys are repeated.  The salt is a hash of the row, so a
    recomputed task places its rows as before.
    """
    flagged = fact.join(F.broadcast(hot.select(*keys, F.lit(True).alias("_hot"))), keys, "left")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns]), F.lit(salts)).cast("int")
    # A key with a NULL matches nothing, but its rows are shuffled like any other: they are spread as well.
    open_key = functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    left = flagged.withColumn("_salt", F.when(F.col("_hot") | open_key, salt).otherwise(0)).drop("_hot")
    marked = dim.join(F.broadcast(hot.select(*keys, F.lit(True).alias("_hot"))), keys, "left")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = marked.withColumn("_salt", F.explode(copies)).drop("_hot")
    right = right.hint(strategy) if strategy else right
    return left.join(right, keys + ["_salt"], how).drop("_salt")


def lookup_join(fact: DataFrame, dim: DataFrame, keys: str | list[str], how: str = "inner") -> DataFrame:
    """Join a large frame to a lookup frame with unique keys.

    A lookup that takes at most ``SENT_BYTES`` is broadcast.  A larger one is
    joined by shuffle, whatever Catalyst takes its size for, with the hot keys
    (at most ``HOT_PARTS``) salted so that none of them ends up in a single task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how not in ("inner", "left"):
        raise ValueError("lookup_join does inner and left joins")
    if sent(dim):
        return fact.join(F.broadcast(dim), keys, how)
    return salted_join(fact, dim, keys, hot_keys(fact.dropna(subset=keys), keys), how, strategy="merge")
