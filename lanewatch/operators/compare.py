"""Comparing two scorings of the same entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewatch.operators.quantiles import quantiles
from lanewatch.operators.ranks import average_rank
from lanewatch.session import keep


def align(a: DataFrame, b: DataFrame, key: str, cols_a: dict, cols_b: dict) -> DataFrame:
    """Inner alignment on the key with renamed columns (out <- source)."""
    return (a.select(key, *[F.col(s).alias(o) for o, s in cols_a.items()])
             .join(b.select(key, *[F.col(s).alias(o) for o, s in cols_b.items()]), on=key))


def with_deltas(aligned: DataFrame) -> DataFrame:
    """label_match and delta_score on an aligned table (label_a/b, score_a/b)."""
    return aligned.withColumns({"label_match": F.col("label_a") == F.col("label_b"),
                                "delta_score": F.col("score_b") - F.col("score_a")})


def summary(aligned: DataFrame, key: str, high: str = "HIGH") -> DataFrame:
    """Agreement, Pearson, Spearman (average ranks), both-HIGH / only-A / only-B counts."""
    r = average_rank(aligned, "score_a", key, "_ra", descending=False)
    r = average_rank(r, "score_b", key, "_rb", descending=False)
    ha, hb = F.col("label_a") == high, F.col("label_b") == high
    return r.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("label_a") == F.col("label_b")).cast("double")).alias("agreement"),
        F.corr("score_a", "score_b").alias("pearson"),
        F.corr("_ra", "_rb").alias("spearman"),
        F.count_if(ha & hb).alias("both_high"),
        F.count_if(ha & ~hb).alias("only_a_high"),
        F.count_if(~ha & hb).alias("only_b_high"),
    )


def label_distribution(aligned: DataFrame) -> DataFrame:
    """Label counts of the two runs side by side."""
    u = (aligned.select(F.col("label_a").alias("label"), F.lit(1).alias("a"), F.lit(0).alias("b"))
                .unionByName(aligned.select(F.col("label_b").alias("label"), F.lit(0).alias("a"), F.lit(1).alias("b"))))
    return u.groupBy("label").agg(F.sum("a").cast("bigint").alias("n_a"), F.sum("b").cast("bigint").alias("n_b"))


def rank_deltas(aligned: DataFrame, key: str) -> DataFrame:
    """W2 + W3: average ranks (descending) of both runs; |delta| mean, median, max + argmax, within 50 / 100."""
    r = average_rank(aligned, "score_a", key, "rank_a").withColumn("rank_a", F.floor("rank_a"))
    r = average_rank(r, "score_b", key, "rank_b").withColumn("rank_b", F.floor("rank_b"))
    r = keep(r.select(key, "rank_a", "rank_b"))
    d = F.abs(F.col("rank_a") - F.col("rank_b"))
    middle = F.lit(quantiles(r, {"d": d}, [0.5])["d"][0]).cast("double")
    return r.agg(F.avg(d).alias("mean_delta"), middle.alias("median_delta"), F.max(d).alias("max_delta"),
                 F.min_by(F.col(key), F.struct(-d, F.col(key))).alias("max_delta_entity"),
                 F.count_if(d <= 50).alias("within_50"), F.count_if(d <= 100).alias("within_100"))


def top_overlap(aligned: DataFrame, key: str, ks=(10, 50)) -> DataFrame:
    """Size of the intersection of the two top-k sets, for each k."""
    out = None
    for k in ks:
        ta = aligned.orderBy(F.desc("score_a"), F.asc(key)).limit(k).select(key)
        tb = aligned.orderBy(F.desc("score_b"), F.asc(key)).limit(k).select(key)
        row = ta.join(tb, on=key).agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("overlap"))
        out = row if out is None else out.unionByName(row)
    return out


def divergent(aligned: DataFrame, key: str, k: int = 15) -> DataFrame:
    """Label mismatches, top-k by |score difference|."""
    d = with_deltas(aligned)
    return (d.filter(~F.col("label_match")).withColumn("abs_delta", F.abs("delta_score"))
             .orderBy(F.desc("abs_delta"), F.asc(key)).limit(k))


def coverage(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys in A, in B, in both, only in A, only in B, in either."""
    ka = a.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_a", F.lit(1))
    kb = b.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_b", F.lit(1))
    j = ka.join(kb, on=key, how="full")
    return j.agg(F.count_if(F.col("_a") == 1).alias("n_a"), F.count_if(F.col("_b") == 1).alias("n_b"),
                 F.count_if((F.col("_a") == 1) & (F.col("_b") == 1)).alias("n_both"),
                 F.count_if(F.col("_b").isNull()).alias("only_a"), F.count_if(F.col("_a").isNull()).alias("only_b"),
                 F.count(F.lit(1)).alias("n_union"))


def only_in(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of A whose key is not in B (anti join)."""
    return a.join(b.select(key).distinct(), on=key, how="left_anti")
