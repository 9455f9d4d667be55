"""Global ranks without a single-partition window (W1, W2) and top-k helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewatch.functions.columns import lookup
from lanewatch.session import keep


def dense_position(df: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """1-based position in a total order, computed as range-partitioned sort +
    per-partition offsets (the offsets table has one row per partition).

    ``order`` must be a total order (end with a unique key) for determinism.
    """
    tagged = (df.orderBy(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = keep(tagged)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"), F.min("_mid").alias("m0")).collect()
    offsets, acc = {}, 0
    for r in sorted(counts, key=lambda r: r["_pid"]):
        offsets[r["_pid"]] = (acc, r["m0"])
        acc += r["n"]
    off = lookup({k: v[0] for k, v in offsets.items()}, F.col("_pid"))
    m0 = lookup({k: v[1] for k, v in offsets.items()}, F.col("_pid"))
    return tagged.withColumn(out, (off + (F.col("_mid") - m0) + 1).cast("bigint")).drop("_pid", "_mid")


def average_rank(df: DataFrame, score: str, key: str, out: str, descending: bool = True) -> DataFrame:
    """Rank with ties averaged (1 = best when descending)."""
    s = F.col(score)
    pos = dense_position(df.select(key, score), [s.desc() if descending else s.asc(), F.col(key).asc()], "_pos")
    ties = pos.groupBy(score).agg(((F.min("_pos") + F.max("_pos")) / 2.0).alias(out))
    tied = ties.withColumnRenamed(score, "_tie")
    return df.join(pos.select(key, score).join(tied, F.col(score).eqNullSafe(F.col("_tie"))).drop(score, "_tie"), on=key)


def top_abs_per_row(df: DataFrame, cols: list[str], k: int = 3, prefix: str = "z_", out: str = "top_drivers") -> DataFrame:
    """Per row, the k columns with the largest |value| (no shuffle)."""
    arr = F.array(*[F.struct((-F.abs(F.col(prefix + c))).alias("neg_abs"), F.lit(i).alias("idx"),
                             F.lit(c).alias("feature"), F.col(prefix + c).alias("z"))
                    for i, c in enumerate(cols)])
    return df.withColumn(out, F.slice(F.array_sort(F.filter(arr, lambda s: s["neg_abs"].isNotNull())), 1, k))


def dense_position_by(df: DataFrame, group: str, order: list[Column], out: str = "rank") -> DataFrame:
    """1-based position inside each ``group`` without a per-group window.

    Rows are range-partitioned on (group, order) — a large group spans several
    partitions — then each (partition, group) slice is counted; offsets are a
    running sum over the small counts table (one row per partition and group).
    """
    tagged = keep(df.orderBy(F.col(group), *order)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()))
    counts = tagged.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    return (tagged.join(F.broadcast(offs), on=["_pid", group])
                  .withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_m0") + 1).cast("bigint"))
                  .drop("_pid", "_mid", "_m0", "_off"))


def average_rank_by(df: DataFrame, group: str, score: str, key: str, out: str, descending: bool = False) -> DataFrame:
    """Average rank (ties averaged) of ``score`` inside each ``group``; distributed on (group, score)."""
    s = F.col(score)
    pos = dense_position_by(df.select(group, key, score), group,
                            [s.desc() if descending else s.asc(), F.col(key).asc()], "_pos")
    ties = pos.groupBy(group, score).agg(((F.min("_pos") + F.max("_pos")) / 2.0).alias(out))
    tied = ties.withColumnsRenamed({group: "_group", score: "_tie"})
    return df.join(tied, (F.col(group) == F.col("_group")) & F.col(score).eqNullSafe(F.col("_tie"))).drop("_group", "_tie")
