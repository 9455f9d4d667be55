"""Statistical baseline over an entity feature table.

Means and deviations come from one aggregation, quantiles from
``quantiles.quantiles`` (exact, by counting in ranges: no column's values meet
in one task); both are a handful of numbers that are inlined as literals, so
no cross join and no driver loop over features.  ``exact=False`` takes the
quantiles from one pass of a sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewatch import constants as K
from lanewatch.functions.columns import sum_cols
from lanewatch.operators.quantiles import quantiles, quantiles_by


def _number(v) -> Column:
    return F.lit(v) if v is not None else F.lit(None).cast("double")


def one_row(df: DataFrame) -> dict:
    """Collect a one-row aggregate (a bounded set of scalars) as a dict of literals.

    Global statistics are tiny; computing them in one aggregation job and
    inlining the values keeps plans small (a scalar subquery per use would copy
    the whole input plan into every expression that reads it).
    """
    row = df.first()
    return {k: _number(v) for k, v in row.asDict(True).items()}


def _x(c: str) -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(0.0))


def available_features(df: DataFrame, features=None) -> tuple[list[str], list[str]]:
    """(used, missing) feature names."""
    features = list(features or K.BASELINE_FEATURES)
    cols = set(df.columns)
    return [c for c in features if c in cols], [c for c in features if c not in cols]


def feature_stats(df: DataFrame, features=None, exact: bool = True) -> DataFrame:
    """B1: one row per feature: mean, std, median, quartiles, IQR, p95, p99,
    Tukey bounds (p95 upper / no lower bound when IQR = 0), z bound, sparse flag."""
    feats, _ = available_features(df, features)
    x = {c: F.col(c).cast("double") for c in feats}
    wide = df.agg(*[e for i, c in enumerate(feats) for e in (
        F.avg(x[c]).alias(f"mean_{i}"), F.stddev_samp(x[c]).alias(f"std_{i}"))])
    found = quantiles(df, x, [0.25, 0.5, 0.75, 0.95, 0.99], exact=exact)
    rows = []
    for i, c in enumerate(feats):
        q1, med, q3, p95, p99 = [_number(v).cast("double") for v in found[c]]
        iqr = q3 - q1
        rows.append(F.struct(
            F.lit(c).alias("feature"), F.col(f"mean_{i}").alias("mean"), F.col(f"std_{i}").alias("std"),
            med.alias("median"), q1.alias("q1"), q3.alias("q3"), iqr.alias("iqr"),
            p95.alias("p95"), p99.alias("p99"),
            F.when(iqr > 0, q3 + 1.5 * iqr).otherwise(p95).alias("tukey_upper"),
            F.when(iqr > 0, q1 - 1.5 * iqr).alias("tukey_lower"),
            (F.col(f"mean_{i}") + K.Z_FLAG * F.col(f"std_{i}")).alias("z_upper"),
            (iqr == 0).cast("int").alias("is_sparse"),
        ))
    return wide.select(F.inline(F.array(*rows)))


def robust_zscores(df: DataFrame, features=None, prefix: str = "z_",
                   score_col: str = "baseline_score", exact: bool = True) -> DataFrame:
    """B3 + B4: robust z per feature and their mean absolute value.

    z = (x - median) / (1.4826 * MAD); when MAD = 0, (x - median) / std;
    when std = 0, 0.  Nulls in features count as 0.
    """
    feats, _ = available_features(df, features)
    st = df.agg(F.count(F.lit(1)).alias("rows"), *[F.stddev_samp(_x(c)).alias(c) for c in feats]).first()
    meds, mads = medians_and_mads(df, feats, st["rows"], exact)
    zs = []
    for c in feats:
        med, std, mad = _number(meds[c]), _number(st[c]), _number(mads[c])
        zs.append(_robust_z(_x(c) - med, mad, std).alias(prefix + c))
    return _mean_abs(df.select("*", *zs), [prefix + c for c in feats], score_col)


def _robust_z(off_median: Column, mad: Column, std: Column) -> Column:
    return (F.when(mad > 0, off_median / (K.MAD_SCALE * mad))
             .when(std.isNull(), F.lit(None).cast("double"))
             .when(std > 0, off_median / std)
             .otherwise(F.lit(0.0)))


def _mean_abs(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    absz = [F.abs(F.col(c)) for c in cols]
    num = sum_cols([F.coalesce(a, F.lit(0.0)) for a in absz])
    den = sum_cols([F.when(a.isNotNull(), 1).otherwise(0) for a in absz])
    return df.withColumn(out, F.when(den > 0, num / den))


def medians_and_mads(df: DataFrame, feats: list[str], rows: int, exact: bool = True) -> tuple[dict, dict]:
    """Median and median absolute deviation of every feature (nulls as 0)."""
    meds = {c: v[0] for c, v in quantiles(df, {c: _x(c) for c in feats}, [0.5], at_most=rows, exact=exact).items()}
    off = {c: F.abs(_x(c) - _number(meds[c])) for c in feats}
    return meds, {c: v[0] for c, v in quantiles(df, off, [0.5], at_most=rows, exact=exact).items()}


def wide_quantiles(df: DataFrame, values: dict, q: float, by: tuple[str, ...], prefix: str) -> DataFrame:
    """by..., one column ``prefix + name`` per value: its q-quantile in every group."""
    long = quantiles_by(df, values, [q], by)
    return long.groupBy(*by).agg(*[F.first(F.when(F.col("column") == c, F.col("q")[0]), True).alias(prefix + c) for c in values])


def robust_zscores_by(df: DataFrame, by: tuple[str, ...], features=None, prefix: str = "z_", score_col: str = "baseline_score") -> DataFrame:
    """B3 + B4 inside every group of ``by``, in one plan: group statistics are joined instead of inlined."""
    feats, _ = available_features(df, features)
    std = df.groupBy(*by).agg(*[F.stddev_samp(_x(c)).alias("_std_" + c) for c in feats])
    med = wide_quantiles(df, {c: _x(c) for c in feats}, 0.5, by, "_med_")
    known = df.join(std, list(by)).join(med, list(by))
    mad = wide_quantiles(known, {c: F.abs(_x(c) - F.col("_med_" + c)) for c in feats}, 0.5, by, "_mad_")
    known = known.join(mad, list(by))
    out = known.select(*df.columns, *[_robust_z(_x(c) - F.col("_med_" + c), F.col("_mad_" + c), F.col("_std_" + c)).alias(prefix + c)
                                      for c in feats])
    return _mean_abs(out, [prefix + c for c in feats], score_col)


def robust_stats(df: DataFrame, features=None, exact: bool = True) -> DataFrame:
    """Per feature mean, std, median, MAD and the scale used by the robust z."""
    feats, _ = available_features(df, features)
    meds, mads = medians_and_mads(df, feats, df.count(), exact)
    wide = df.agg(*[e for i, c in enumerate(feats) for e in (
        F.avg(_x(c)).alias(f"mean_{i}"), F.stddev_samp(_x(c)).alias(f"std_{i}"))])
    rows = []
    for i, c in enumerate(feats):
        mad, std = _number(mads[c]).cast("double"), F.col(f"std_{i}")
        rows.append(F.struct(
            F.lit(c).alias("feature"), F.col(f"mean_{i}").alias("mean"), std.alias("std"),
            _number(meds[c]).cast("double").alias("median"), mad.alias("mad"),
            F.when(mad > 0, K.MAD_SCALE * mad).when(std > 0, std).otherwise(F.lit(0.0)).alias("scale")))
    return wide.select(F.inline(F.array(*rows)))


def label_by_quantiles(df: DataFrame, score_col: str, out_col: str,
                       q_high: float = K.LABEL_QUANTILE_HIGH, q_medium: float = K.LABEL_QUANTILE_MEDIUM,
                       floor_high: float | None = None, floor_medium: float | None = None,
                       exact: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """HIGH at or above the q_high quantile (of the whole table or of the row's group), MEDIUM at or above q_medium."""
    if by:
        q = quantiles_by(df, {"s": score_col}, [q_high, q_medium], by).select(
            *by, F.col("q")[0].alias("_hi"), F.col("q")[1].alias("_med"))
        return df.join(q, list(by), "left").withColumn(out_col, F.when(F.col(score_col) >= F.col("_hi"), "HIGH").when(
            F.col(score_col) >= F.col("_med"), "MEDIUM").otherwise("NORMAL")).drop("_hi", "_med")
    hi, med = [_number(v) for v in quantiles(df, {"s": score_col}, [q_high, q_medium], exact=exact)["s"]]
    if floor_high is not None:
        hi = F.greatest(hi, F.lit(floor_high))
    if floor_medium is not None:
        med = F.greatest(med, F.lit(floor_medium))
    s = F.col(score_col)
    return df.withColumn(out_col, F.when(s >= hi, "HIGH").when(s >= med, "MEDIUM").otherwise("NORMAL"))


def classic_baseline(df: DataFrame, features=None, exact: bool = True) -> DataFrame:
    """B2 + B6: classic z (std = 0 -> 1), hybrid Tukey-or-z flags, counts."""
    feats, _ = available_features(df, features)
    st = one_row(df.agg(*[e for i, c in enumerate(feats) for e in (
        F.avg(F.col(c)).alias(f"mean_{i}"), F.stddev_samp(F.col(c)).alias(f"std_{i}"))]))
    found = quantiles(df, {c: c for c in feats}, [0.25, 0.75, 0.95], exact=exact)
    cols, flags = [], []
    for i, c in enumerate(feats):
        std = F.when(st[f"std_{i}"] == 0, F.lit(1.0)).otherwise(st[f"std_{i}"])
        z = (F.col(c) - st[f"mean_{i}"]) / std
        q1, q3, p95 = [_number(v) for v in found[c]]
        upper = F.when(q3 - q1 > 0, q3 + 1.5 * (q3 - q1)).otherwise(p95)
        cols.append(z.alias("z_" + c))
        flags.append(((F.col(c) > upper) | (z > K.Z_FLAG)).cast("int").alias("flag_" + c))
    out = df.select("*", *cols, *flags)
    n = sum_cols([F.col("flag_" + c) for c in feats])
    return (out.withColumn("n_anomalie", n)
               .withColumn("pct_anomalie", F.bround(F.col("n_anomalie") / F.lit(float(len(feats))), 4)))


def baseline_report(flagged: DataFrame, features=None) -> DataFrame:
    """Per feature, entities flagged and percent of all entities."""
    feats, _ = available_features(flagged, ["flag_" + c for c in (features or K.BASELINE_FEATURES)])
    wide = flagged.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c)).alias(f"s{i}") for i, c in enumerate(feats)])
    rows = [F.struct(F.lit(c[5:]).alias("feature"), F.col(f"s{i}").cast("bigint").alias("n_flagged"),
                     F.round(F.col(f"s{i}") * 100.0 / F.col("n"), 2).alias("pct_flagged"))
            for i, c in enumerate(feats)]
    return wide.select(F.inline(F.array(*rows)))


def degeneracy(df: DataFrame, score_col: str = "baseline_score", features=None,
               min_features: int = 5, min_std: float = 0.01) -> DataFrame:
    """One row — is the baseline too flat to rank?  Null std counts as degenerate."""
    feats, _ = available_features(df, features)
    return df.agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.lit(len(feats)).alias("n_features"),
        F.stddev_samp(score_col).alias("score_std"),
    ).withColumn("is_degenerate",
                 (F.col("n_features") < min_features) | F.col("score_std").isNull()
                 | (F.col("score_std") < min_std))
