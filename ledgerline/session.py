"""Session settings and the shared folder used for written tables and checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", name: str = "ledgerline") -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only where ``spark.checkpoint.dir`` is unset (local tests) is a fresh
    temporary folder made and remembered for the rest of the session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.getCheckpointDir():
        return spark.sparkContext.getCheckpointDir()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="ledgerline-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; nothing is ever overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Point the context's checkpoint directory at the shared folder, once."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


def materialised(df: DataFrame) -> DataFrame:
    """The frame written to the checkpoint folder: computed once, and safe when executors go away."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint()


#: Tables written by ``stored``, oldest first, per application.
OWNED: dict[str, list[str]] = {}


def owned(spark: SparkSession) -> list[str]:
    return OWNED.setdefault(spark.sparkContext.applicationId, [])


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written below the shared folder as Parquet and read again: cut lineage, known size.

    The path is remembered, so that ``release`` can remove what the session's jobs have written.
    """
    spark, schema = df.sparkSession, df.schema
    path = fresh_path(spark, label)
    df.write.parquet(path)
    owned(spark).append(path)
    out = spark.read.schema(schema).parquet(path)
    out.stored_at = path
    return out


def release(spark: SparkSession, since: int = 0, keep: Iterable[DataFrame] = (), only: Iterable[str] | None = None) -> None:
    """Remove tables written by ``stored``, from the ``since``-th on, but for those in ``keep``; or those ``only``, by path.

    Frames that still read them can't be used afterwards.  ``len(owned(spark))`` before a piece of work is the
    ``since`` that stands for what it writes.
    """
    jvm, conf, tables = spark._jvm, spark._jsc.hadoopConfiguration(), owned(spark)
    kept = {getattr(df, "stored_at", None) for df in keep}
    named = tables[since:] if only is None else [p for p in only if p in tables]
    for place in [p for p in named if p not in kept]:
        path = jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(conf).delete(path, True)
        tables.remove(place)


def shuffle_width(spark: SparkSession, ceiling: int = 512) -> int:
    """How many range buckets to cut ordered work into: follows the cluster's own setting."""
    return max(4, min(ceiling, int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))
