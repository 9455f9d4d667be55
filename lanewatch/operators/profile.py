"""Profiling, EDA and roll-up operators over feeds and entity tables.

Every operator is one or two aggregations; multi-dimension reports unpivot the
dimensions first (equivalent to GROUPING SETS) so all dimensions share one
shuffle.  Nothing collects rows: only bounded scalar lists (top-k) reach the
driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewatch.functions.columns import safe_div
from lanewatch.operators.baseline import one_row
from lanewatch.operators.quantiles import quantiles, quantiles_by


def dataset_stats(feed: DataFrame, key: str = "ROTTA", top: int = 5, exact: bool = True) -> DataFrame:
    """Rows, distinct routes, airports and countries, years present, top countries, rows with TOT > 0."""
    top_c = [r[0] for r in (feed.filter(F.col("PAESE_PART").isNotNull()).groupBy("PAESE_PART")
                            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "PAESE_PART")
                            .limit(top).collect())]  # top-k: bounded
    count = F.count_distinct if exact else F.approx_count_distinct
    return feed.agg(
        F.count(F.lit(1)).alias("n_righe"),
        count(key).alias("n_rotte_uniche"),
        count("AREOPORTO_PARTENZA").alias("n_aeroporti_part"),
        count("AREOPORTO_ARRIVO").alias("n_aeroporti_arr"),
        count("PAESE_ARR").alias("n_paesi_arr"),
        F.array_join(F.sort_array(F.collect_set(F.col("ANNO_PARTENZA").cast("int").cast("string"))), ",")
        .alias("anni_presenti"),
        F.lit(",".join(top_c)).alias("paesi_partenza_top5"),
        F.count_if(F.coalesce(F.col("TOT").cast("double"), F.lit(0.0)) > 0).alias("n_con_allarmi"),
    )


def describe(df: DataFrame, cols, digits: int = 2) -> DataFrame:
    """Count, mean, std, min, quartiles, max, bias-corrected skewness and kurtosis."""
    rows = []
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.skewness(x).alias(f"g1_{i}"), F.kurtosis(x).alias(f"g2_{i}")]
    wide = df.agg(*aggs)
    found = quantiles(df, {c: c for c in cols}, [0.25, 0.5, 0.75])
    for i, c in enumerate(cols):
        q = [F.lit(v).cast("double") for v in found[c]]
        n = F.col(f"n{i}").cast("double")
        skew = F.when(n > 2, F.col(f"g1_{i}") * F.sqrt(n * (n - 1)) / (n - 2))
        kurt = F.when(n > 3, ((n + 1) * F.col(f"g2_{i}") + 6) * (n - 1) / ((n - 2) * (n - 3)))
        rows.append(F.struct(
            F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
            *[F.round(e, digits).alias(a) for e, a in [
                (F.col(f"m{i}"), "mean"), (F.col(f"s{i}"), "std"), (F.col(f"lo{i}"), "min"),
                (q[0], "p25"), (q[1], "p50"), (q[2], "p75"),
                (F.col(f"hi{i}"), "max"), (skew, "skewness"), (kurt, "kurtosis")]]))
    return wide.select(F.inline(F.array(*rows)))


def correlation_matrix(df: DataFrame, cols) -> DataFrame:
    """Pearson r for every ordered pair (one aggregation)."""
    pairs = [(a, b) for a in cols for b in cols]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}")
                    for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)])))


def rate_by(df: DataFrame, dims, num: str = "ALLARMATI", den: str = "ENTRATI") -> DataFrame:
    """Ratio of sums per value of each dimension, all dimensions in one shuffle."""
    u = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
                            for d in dims]))
    g = (df.select(F.col(num).cast("double").alias("_n"), F.col(den).cast("double").alias("_d"), u.alias("u"))
           .filter(F.col("u.value").isNotNull())
           .groupBy(F.col("u.dimension").alias("dimension"), F.col("u.value").alias("value"))
           .agg(F.sum("_d").alias(den.lower()), F.sum("_n").alias(num.lower())))
    return g.withColumn("alarm_rate", safe_div(F.col(num.lower()), F.col(den.lower()), None))


def top_rates(df: DataFrame, dim: str, min_volume: float = 30, excluded=(), k: int = 20,
              num: str = "ALLARMATI", den: str = "ENTRATI") -> DataFrame:
    """HAVING volume >= min, excluded codes removed, top-k by rate."""
    g = (df.filter(F.col(dim).isNotNull() & ~F.col(dim).isin(list(excluded)))
           .groupBy(dim).agg(F.sum(den).alias("entrati"), F.sum(num).alias("allarmati"))
           .filter(F.col("entrati") >= min_volume)
           .withColumn("alarm_rate", F.col("allarmati") / F.col("entrati")))
    return g.orderBy(F.desc("alarm_rate"), dim).limit(k)


def cross_tab_rate(df: DataFrame, row: str, col: str, values, num: str = "ALLARMATI",
                   den: str = "ENTRATI") -> DataFrame:
    """Two-way rate table (rows x fixed column order), NULL where no volume."""
    g = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row)
    return g.pivot(col, list(values)).agg(safe_div(F.sum(num), F.sum(den), None))


def frequency(df: DataFrame, col: str, domain=None) -> DataFrame:
    """Counts and percent of non-null total; fixed domain zero-filled when given."""
    cnt = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if domain is not None:
        spark = df.sparkSession
        dom = spark.createDataFrame([(i, str(v)) for i, v in enumerate(domain)], f"ord int, {col} string")
        cnt = dom.join(cnt, on=col, how="left").select("ord", col, F.coalesce("n", F.lit(0)).alias("n"))
    tot = cnt.select(F.sum("n")).scalar()
    return cnt.withColumn("pct", F.round(F.col("n") * 100.0 / tot, 1))


def monthly_trend(df: DataFrame, cols, ts: str = "DATA_PARTENZA") -> DataFrame:
    """Sums per calendar month of the parsed date."""
    return (df.filter(F.col(ts).isNotNull()).groupBy(F.month(ts).alias("mese"))
              .agg(*[F.sum(c).alias(c) for c in cols]))


def monthly_volume(a: DataFrame, b: DataFrame, ts: str = "DATA_PARTENZA", names=("alarms", "travellers")) -> DataFrame:
    """Rows per month of two feeds side by side (tagged union + pivot)."""
    u = (a.select(F.date_format(ts, "yyyy-MM").alias("month"), F.lit(names[0]).alias("feed"))
          .unionByName(b.select(F.date_format(ts, "yyyy-MM").alias("month"), F.lit(names[1]).alias("feed"))))
    return u.filter(F.col("month").isNotNull()).groupBy("month").pivot("feed", list(names)).count().na.fill(0)


def top_by_sum(df: DataFrame, dim: str, col: str, k: int = 10) -> DataFrame:
    """Top-k values of ``dim`` by the sum of a cleaned numeric column."""
    return (df.filter(F.col(dim).isNotNull()).groupBy(dim).agg(F.sum(col).alias("volume"))
              .orderBy(F.desc("volume"), dim).limit(k))


def confusion(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cross-tab of two labellings with percent of all rows."""
    n = df.count()
    return (df.groupBy(F.col(a).alias("label_a"), F.col(b).alias("label_b"))
              .agg(F.count(F.lit(1)).alias("n"))
              .withColumn("pct", F.round(F.col("n") * 100.0 / F.lit(n), 2)))


def group_contrast(df: DataFrame, flag: Column, features) -> DataFrame:
    """Mean per feature in flagged vs other rows; ratio (NULL when base is 0); >= 2x flag."""
    aggs = []
    for i, c in enumerate(features):
        aggs += [F.avg(F.when(flag, F.col(c))).alias(f"a{i}"), F.avg(F.when(~flag, F.col(c))).alias(f"b{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias("mean_anomalous"),
                     F.col(f"b{i}").alias("mean_normal"),
                     F.when(F.col(f"b{i}") != 0, F.col(f"a{i}") / F.col(f"b{i}")).alias("ratio"))
            for i, c in enumerate(features)]
    return (wide.select(F.inline(F.array(*rows)))
                .withColumn("is_2x", F.coalesce(F.col("ratio") >= 2, F.lit(False))))


def observability(df: DataFrame, count_col: str = "n_osservazioni_viag", threshold: int = 30,
                  value: str = "score_composito") -> DataFrame:
    """Low-observability flag and a describe of ``value`` per group."""
    flagged = df.select((F.col(count_col) < threshold).alias("low_observability"), F.col(value).cast("double").alias("_v"))
    g = flagged.groupBy("low_observability").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"),
        F.min("_v").alias("min"), F.max("_v").alias("max"))
    q = quantiles_by(flagged, {"_v": "_v"}, [0.25, 0.5, 0.75], ("low_observability",)) \
        .select(F.col("low_observability").alias("_g"), "q")
    return g.join(q, F.col("low_observability").eqNullSafe(F.col("_g")), "left").select(
        "low_observability", "n", "mean", "std", "min", *[F.get("q", F.lit(i)).alias(f"p{25 * (i + 1)}") for i in range(3)], "max")


def quantile_trim(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    """Rows with ``col`` <= its q-quantile."""
    cap = quantiles(df, {col: col}, [q])[col][0]
    return df.filter(F.col(col) <= F.lit(cap).cast("double"))


def histogram(df: DataFrame, col: str, bins: int = 30, group: str | None = None) -> DataFrame:
    """Equal-width bins between min and max (top edge in the last bin), zero-filled."""
    st = one_row(df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")))
    lo, hi = st["lo"], st["hi"]
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi > lo, F.least(F.floor((F.col(col) - lo) / width).cast("int"), F.lit(bins - 1))).otherwise(0)
    keys = ([F.col(group).alias("grp")] if group else [])
    cnt = df.filter(F.col(col).isNotNull()).groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    if group:  # bin domain per group by generating the bin ids, not by joining
        groups = df.select(F.col(group).alias("grp")).filter(F.col("grp").isNotNull()).distinct()
        dom = groups.select("grp", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        out = dom.join(cnt, on=["grp", "bin"], how="left")
    else:
        dom = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
        out = dom.join(cnt, on="bin", how="left")
    return out.select(*(["grp"] if group else []), "bin",
                      (lo + F.col("bin") * width).alias("lo"), (lo + (F.col("bin") + 1) * width).alias("hi"),
                      F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def box_summary(df: DataFrame, col: str, group: str) -> DataFrame:
    """Quartiles, 1.5*IQR whiskers (clamped to data) and outlier count per group."""
    q = quantiles_by(df, {col: col}, [0.25, 0.5, 0.75], (group,))
    q = q.select(group, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    j = df.select(group, col).join(q, on=group)
    lo_f = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi_f = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col(col) >= lo_f) & (F.col(col) <= hi_f)
    return j.groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(col))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(col))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))


def least_squares(df: DataFrame, y: str, x: str) -> DataFrame:
    """Slope and intercept of y on x."""
    return df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                  F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                  F.regr_r2(F.col(y), F.col(x)).alias("r2"))


def column_samples(df: DataFrame, cols, order: str = "_rid", n: int = 3) -> DataFrame:
    """First n non-null values of each column in row order (one top-n per column)."""
    parts = [df.filter(F.col(c).isNotNull()).orderBy(order).limit(n)
               .select(F.lit(c).alias("column"), F.col(order).alias("row_id"), F.col(c).cast("string").alias("value"))
             for c in cols]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
