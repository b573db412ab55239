"""Session construction and lineage cutting.

Cluster jobs read ``spark.checkpoint.dir`` from the session; only tests set one themselves.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "salesforge", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    AQE stays on so shuffle partition counts coalesce at runtime and skewed join
    partitions split; the session time zone is pinned so date parts are stable;
    oversized generated methods fall back to code the JIT compiles.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Generated methods above HotSpot's 8000-byte JIT limit would run interpreted;
        # let Spark fall back to per-expression code for those (wide aggregates and
        # many-column projections) instead.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # Checkpoint files go when the frame that reads them does.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Set a checkpoint folder only where none is configured (tests, local runs)."""
    d = checkpoint_dir(spark)
    if d:
        return d
    os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage of a reused intermediate.

    With a configured checkpoint folder this is a reliable ``checkpoint`` (survives
    executor loss without recomputing the whole lineage).  Without one it falls back to
    ``persist(MEMORY_AND_DISK)``, which keeps the lineage so lost blocks are recomputed.
    """
    if checkpoint_dir(df.sparkSession):
        return df.checkpoint(eager=eager)
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    if eager:
        out.count()
    return out
