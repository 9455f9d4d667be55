"""Small Spark helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewatch.session import checkpoint_dir, cut_lineage


#: most rows and bytes of an Arrow batch between Spark and Python workers
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2500, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch limits to BATCH, so that batches of long texts stay small on both sides."""
    for name, most in BATCH.items():
        now = int(spark.conf.get(name, str(most + 1)))
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder; cleaned with its last reference."""
    return cut_lineage(df)


def kept_by(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Checkpoint in n partitions by the keys, so that later joins on them leave these rows where they are.

    An adaptive plan does not tell its partitioning; the checkpoint is taken with a fixed one.
    """
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return kept(df.repartition(n, *keys))
    finally:
        conf.set("spark.sql.adaptive.enabled", before)


def shared_dir(spark: SparkSession) -> str:
    return checkpoint_dir(spark).rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder; the caller removes it when its files are read."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def replace_columns(df: DataFrame, *fields: T.StructField) -> T.StructType:
    """Schema of ``df`` with the named fields replaced in place or added at the end."""
    new = {f.name: f for f in fields}
    out = [new.pop(f.name, f) for f in df.schema.fields]
    return T.StructType(out + list(new.values()))


def dense_index(df: DataFrame, label: str, order: list[str], name: str, per_task: int = 50_000) -> DataFrame:
    """Number the rows of every label 0, 1, ... in column ``name``, no label in one task.

    Rows are dealt over hash buckets of ``order``; ranks inside (label, bucket)
    are shifted by the counts of the label's earlier buckets. Only those counts
    (rows / per_task per label) meet in one place. ``order`` must make rows
    distinct up to identical ones, so that recomputation gives the same numbers.
    """
    from pyspark.sql import Window
    rows = df.count()
    n = max(1, -(-rows // per_task))
    b = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(n)))
    counts = b.groupBy(label, "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(F.col(label).alias("_label"), F.col("_b").alias("_bucket"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(label, "_b").orderBy(*order)
    ranked = b.withColumn("_r", F.row_number().over(inside) - 1)
    return (ranked.join(shifts, (F.col(label).eqNullSafe(F.col("_label"))) & (F.col("_b") == F.col("_bucket")))
            .withColumn(name, F.col("_r") + F.col("_shift"))
            .drop("_b", "_r", "_label", "_bucket", "_shift"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco
