"""Score normalisation, weighted blend, labels and votes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewatch import constants as K
from lanewatch.functions.columns import clip, minmax_scaled, sum_cols
from lanewatch.operators.baseline import label_by_quantiles, one_row


def minmax(df: DataFrame, cols: dict[str, str], invert: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Min-max each source column to [0, 1] (constant -> 0), over the table or every group of ``by``;
    one aggregation for all columns.  ``cols`` maps out <- source."""
    aggs = [e for i, src in enumerate(cols.values()) for e in (
        F.min(F.coalesce(F.col(src).cast("double"), F.lit(0.0))).alias(f"lo_{i}"),
        F.max(F.coalesce(F.col(src).cast("double"), F.lit(0.0))).alias(f"hi_{i}"))]
    if by:
        ends = [a for i in range(len(cols)) for a in (f"lo_{i}", f"hi_{i}")]
        st = {a: F.col(a) for a in ends}
        df = df.join(df.groupBy(*by).agg(*aggs), list(by))
    else:
        ends, st = [], one_row(df.agg(*aggs))
    out = {}
    for i, (dst, src) in enumerate(cols.items()):
        x = F.coalesce(F.col(src).cast("double"), F.lit(0.0))
        lo, hi = st[f"lo_{i}"], st[f"hi_{i}"]
        out[dst] = minmax_scaled(x, lo, hi) if not invert else minmax_scaled(-x, -hi, -lo)
    return df.withColumns(out).drop(*ends)


def effective_weights(weights: dict | None = None, active=None) -> dict[str, float]:
    """Renormalise weights over the active detectors (excluded ones get 0)."""
    w = dict(weights or K.ENSEMBLE_WEIGHTS)
    active = list(active or w)
    tot = sum(w[d] for d in active)
    return {d: (w[d] / tot if d in active and tot > 0 else 0.0) for d in w}


def blend(df: DataFrame, weights: dict[str, float], out: str = "ensemble_score") -> DataFrame:
    """clip(sum w_d * score_d, 0, 1) over the detectors with non-zero weight."""
    terms = [F.coalesce(F.col(K.DETECTOR_SCORE_COLUMNS[d]), F.lit(0.0)) * F.lit(float(w))
             for d, w in weights.items() if w != 0.0]
    return df.withColumn(out, clip(sum_cols(terms), 0, 1))


def label(df: DataFrame, score_col: str = "ensemble_score", out: str = "anomaly_label",
          floors: tuple[float, float] | None = None, exact: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """HIGH >= p97, MEDIUM >= p90 (optional floors 0.30 / 0.20)."""
    fh, fm = floors if floors else (None, None)
    return label_by_quantiles(df, score_col, out, floor_high=fh, floor_medium=fm, exact=exact, by=by)


def votes(df: DataFrame, cutoffs: dict | None = None) -> DataFrame:
    """Number of detectors whose normalised score passes its cut-off."""
    cutoffs = cutoffs or K.VOTE_CUTOFFS
    terms = [(F.coalesce(F.col(K.DETECTOR_SCORE_COLUMNS[d]), F.lit(0.0)) >= c).cast("int")
             for d, c in cutoffs.items() if K.DETECTOR_SCORE_COLUMNS[d] in df.columns]
    return df.withColumn("n_models_flagged", sum_cols(terms))


def strict_second_pass(scored: DataFrame, scaled: DataFrame, features, key: str = "ROTTA",
                       contamination: float = 0.03, n_trees: int = 300, min_high: int = 5,
                       seed: int = 42) -> DataFrame:
    """Refit the forest at a stricter contamination on the whole population;
    robust_high = first-pass HIGH and strict anomaly.  Below ``min_high`` HIGH rows the
    pass is skipped and HIGH rows count as verified.  The strict score is kept on all rows."""
    from lanewatch.operators.detectors import iforest as IF
    n_high = scored.filter(F.col("anomaly_label") == "HIGH").count()
    if n_high < min_high:
        return scored.withColumns({"robust_high": F.col("anomaly_label") == "HIGH",
                                   "second_pass_score_if": F.lit(None).cast("double")})
    forest = IF.fit(scaled, list(features), key=key, n_trees=n_trees, seed=seed)
    s = IF.with_prediction(IF.score(scaled, forest, list(features), key=key, out="second_pass_score_if"),
                           contamination, col="second_pass_score_if", out="_strict_normal")
    return (scored.join(s, on=key, how="left")
                  .withColumn("robust_high", (F.col("anomaly_label") == "HIGH") & ~F.col("_strict_normal"))
                  .drop("_strict_normal"))


def supervision_summary(sup: DataFrame, max_downgrade: float = 0.5) -> DataFrame:
    """D12 + D13: first-pass HIGH, strict anomalies, robust HIGH, downgrades, robustness rate,
    and whether the downgrade rate crosses the re-run threshold."""
    high = F.col("anomaly_label") == "HIGH"
    g = sup.agg(F.count_if(high).alias("n_first_pass_high"),
                F.count_if(F.col("robust_high")).alias("n_robust_high"))
    return g.select("*", (F.col("n_first_pass_high") - F.col("n_robust_high")).alias("n_downgraded"),
                    F.round(F.col("n_robust_high") / F.greatest(F.col("n_first_pass_high"), F.lit(1)), 4).alias("robustness_rate"),
                    ((F.col("n_first_pass_high") - F.col("n_robust_high")) / F.greatest(F.col("n_first_pass_high"), F.lit(1))
                     > max_downgrade).alias("rerun_suggested"))
