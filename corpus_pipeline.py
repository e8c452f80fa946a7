"""The corpus pipeline: five stages over the documents, each written as Parquet and read again by the next one.

A stage gets the session, the documents its predecessor kept and the folder of the tables; it returns documents with
all their columns, the last one with the draw of the mix added.  Null and empty texts fail the quality rules and go there;
repeated rows are one document to near-dedup; an empty table passes through; columns of any name are handed on.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.mixing import mix
from ledgerline.llm.phrase_index import drop_contaminated
from ledgerline.llm.pii import mask
from ledgerline.llm.quality_rules import keep_good
from ledgerline.llm.queries import MIX
from ledgerline.llm.simhash import keep_one
from ledgerline.session import owned, release, stored
from ledgerline.sources.tables import SourceRegistry


#: Per application, the tables that the stage before has written for its result.
BEHIND: dict[str, list[str]] = {}


def stage(work):
    """A stage that first removes the tables of the stage before: its result has been written by then, and is ``docs`` here."""

    @functools.wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, only=BEHIND.pop(spark.sparkContext.applicationId, []))
        before = set(owned(spark))
        out = work(spark, docs, sf_dir)
        BEHIND[spark.sparkContext.applicationId] = [p for p in owned(spark) if p not in before]
        return out

    return run


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or are more likely bad than good by the weighed rules, go."""
    return keep_good(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Linked are fingerprints at most 2 bits apart, and texts whose five-word shingles have a similarity of 0.8 or more.
    """
    return keep_one(docs, similar=0.8)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages beyond the allowed share go."""
    return drop_contaminated(docs, SourceRegistry(spark, sf_dir).benchmark)


@stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows the new text."""
    masked = mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


@stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the mix, with weight, probability and how many copies to train on."""
    return mix(docs, MIX).filter("copies > 0")


STAGES = [
    ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
    ("personal_data", personal_data), ("mixed", mixed),
]
#: EM, fingerprints and raking have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = SourceRegistry(spark, sf_dir).documents
    for name, work in STAGES[:-1]:
        read, docs = docs, stored(work(spark, docs, sf_dir), name)
        release(spark, only=[getattr(read, "stored_at", "")])
    return STAGES[-1][1](spark, docs, sf_dir)
