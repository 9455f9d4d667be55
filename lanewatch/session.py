"""Spark session defaults and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every lanewatch job wants; all are ordinary Spark SQL confs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a checkpoint's files go with its last reference
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Building plans from Python costs a JVM round trip per call; skip the
    # per-call Python stack capture used only for error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, app: str = "lanewatch",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", "16g")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is given and must point at shared storage; it is
    only filled in here when unset (local runs and tests), with a fresh
    scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="lanewatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def in_few_parts(df: DataFrame, rows: int) -> DataFrame:
    """A table of ``rows`` rows in about 20,000 a partition, but in two a core: a shuffle writes a file for every pair of partitions."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // 20_000)))


_KEPT: list[DataFrame] = []


def keep(df: DataFrame) -> DataFrame:
    """Materialise an intermediate table and cut its lineage.

    A reliable checkpoint into the shared ``spark.checkpoint.dir`` (never a
    local checkpoint): later plans start from a plain scan, so they stay small
    (no growing tree of cached plans for the optimizer to match), and a lost
    executor re-reads the files instead of recomputing the upstream joins.
    Used for entity-level tables (one row per entity) read by several statistics.
    """
    from pyspark import StorageLevel
    checkpoint_dir(df.sparkSession)
    staged = df.persist(StorageLevel.MEMORY_AND_DISK)  # the checkpoint write reads this, not the lineage
    out = staged.checkpoint(eager=True)
    staged.unpersist(blocking=False)
    _KEPT.append(out)
    return out


def release_all() -> None:
    while _KEPT:
        try:
            _KEPT.pop().unpersist(blocking=False)
        except Exception:  # session already stopped
            pass


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
