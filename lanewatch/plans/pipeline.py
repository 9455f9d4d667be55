"""End-to-end risk pipeline: feeds -> features -> baseline -> detectors -> rules.

A plain function over lazy DataFrames.  The feature table and the scored table
are persisted (they are small — one row per entity — and read by several
statistics); ``checkpoint=True`` writes them to the shared checkpoint folder
instead, cutting lineage so a lost executor never re-runs the feed joins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewatch import constants as K
from lanewatch.operators import baseline as B
from lanewatch.operators import features as FT
from lanewatch.operators import rules as R
from lanewatch.operators.detectors import ensemble as EN
from lanewatch.session import cut_lineage, in_few_parts, keep


@dataclass
class PipelineResult:
    features: DataFrame
    baseline: DataFrame
    scored: DataFrame
    risk: DataFrame
    weights: dict = field(default_factory=dict)
    status: str = "ok"


def materialise(df: DataFrame, checkpoint: bool = False) -> DataFrame:
    return cut_lineage(df) if checkpoint else keep(df)


def score_entities(baseline: DataFrame, detectors=("IF", "LOF", "Z", "AE"), key: str = "ROTTA",
                   features=None, seed: int = K.RANDOM_STATE, ae_epochs: int | None = None):
    """D2–D10 on a baseline table; returns (scored, effective weights)."""
    feats = list(features or K.BASELINE_FEATURES)
    df = baseline
    active = []
    if "Z" in detectors:
        df = EN.minmax(df, {"score_z": "baseline_score"})
        active.append("Z")
    else:
        df = df.withColumn("score_z", F.lit(0.0))
    if any(d in detectors for d in ("IF", "LOF", "AE")):
        from lanewatch.operators.detectors import autoencoder as AE
        from lanewatch.operators.detectors import iforest as IF
        from lanewatch.operators.detectors import lof as LOF
        from lanewatch.operators.detectors.scaling import standard_scale
        scaled = keep(in_few_parts(standard_scale(df.select(key, *feats), feats), df.count()))
        scores = df.select(key)
        if "IF" in detectors or "AE" in detectors:
            forest = IF.fit(scaled, feats, key=key, n_trees=K.N_TREES, max_samples=K.MAX_SAMPLES, seed=seed)
            s_if = IF.score(scaled, forest, feats, key=key)
            s_if = keep(IF.with_prediction(keep(s_if), K.CONTAMINATION))
            if "IF" in detectors:
                scores = scores.join(EN.minmax(s_if, {"score_if": "if_score"}).select(key, "score_if", "if_normal"),
                                     on=key)
                active.append("IF")
            else:
                scores = scores.join(s_if.select(key, "if_normal"), on=key)
        if "LOF" in detectors:
            lof = keep(LOF.local_outlier_factor(scaled, feats, key=key, k=K.N_NEIGHBORS))
            # a single entity has no neighbours: it keeps its row and counts 0
            scores = scores.join(EN.minmax(lof, {"score_lof": "lof"}).select(key, "score_lof"), on=key, how="left")
            active.append("LOF")
        if "AE" in detectors:
            ae = AE.autoencoder_scores(scaled.join(scores.select(key, "if_normal"), on=key), feats, key=key,
                                       normal_col="if_normal", seed=seed, epochs=ae_epochs)
            if ae is not None:
                scores = scores.join(keep(ae), on=key)
                active.append("AE")
        df = df.join(keep(scores), on=key, how="left")
    for d in ("IF", "LOF", "AE"):
        c = K.DETECTOR_SCORE_COLUMNS[d]
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0.0))
    w = EN.effective_weights(K.ENSEMBLE_WEIGHTS, active)
    df = keep(EN.blend(df, w))
    df = EN.label(df)
    df = EN.votes(df)
    return df, w


def risk_pipeline(alarms: DataFrame, travellers: DataFrame, detectors=("IF", "LOF", "Z", "AE"),
                  key: str = "ROTTA", checkpoint: bool = False, seed: int = K.RANDOM_STATE,
                  ae_epochs: int | None = None) -> PipelineResult:
    feats = materialise(FT.entity_features(alarms, travellers, key), checkpoint)
    return risk_of_features(feats, detectors, key, checkpoint, seed, ae_epochs)


def risk_of_features(feats: DataFrame, detectors=("IF", "LOF", "Z", "AE"), key: str = "ROTTA", checkpoint: bool = False,
                     seed: int = K.RANDOM_STATE, ae_epochs: int | None = None) -> PipelineResult:
    base = B.robust_zscores(feats)
    base = B.label_by_quantiles(base, "baseline_score", "baseline_flag")
    scored, w = score_entities(base, detectors, key=key, seed=seed, ae_epochs=ae_epochs)
    scored = materialise(scored, checkpoint)
    risk = R.apply_rules(scored)
    return PipelineResult(features=feats, baseline=base, scored=scored, risk=risk, weights=w)


def score_entities_by(baseline: DataFrame, group_col: str, key: str = "ROTTA", features=None, seed: int = K.RANDOM_STATE) -> DataFrame:
    """``score_entities`` with all four detectors inside every group, in one set of jobs."""
    from lanewatch.operators.detectors import autoencoder as AE
    from lanewatch.operators.detectors import iforest as IF
    from lanewatch.operators.detectors import lof as LOF
    from lanewatch.operators.detectors.scaling import standard_scale
    feats, by, ids = list(features or K.BASELINE_FEATURES), (group_col,), [group_col, key]
    df = EN.minmax(baseline, {"score_z": "baseline_score"}, by=by)
    scaled = keep(standard_scale(df.select(*ids, *feats), feats, by=by))
    forest = IF.fit(scaled, feats, key=key, n_trees=K.N_TREES, max_samples=K.MAX_SAMPLES, seed=seed, group_col=group_col,
                    own_draws=False)
    s_if = keep(IF.with_prediction(keep(IF.score_by(scaled, forest, feats, group_col, key)), K.CONTAMINATION, by=by))
    scores = EN.minmax(s_if, {"score_if": "if_score"}, by=by).select(*ids, "score_if", "if_normal")
    lof = keep(LOF.local_outlier_factor_by(scaled, feats, group_col, key, K.N_NEIGHBORS))
    known = EN.minmax(lof.filter("lof IS NOT NULL"), {"score_lof": "lof"}, by=by)
    scores = scores.join(known.select(*ids, "score_lof"), ids, "left")
    ae = AE.autoencoder_scores_by(scaled.join(s_if.select(*ids, "if_normal"), ids), feats, group_col, key, seed=seed)
    df = df.join(keep(scores.join(ae, ids, "left")), ids, "left")
    # a group without an autoencoder spreads its weight over the others
    with_ae, without = (EN.effective_weights(K.ENSEMBLE_WEIGHTS, d) for d in (["Z", "IF", "LOF", "AE"], ["Z", "IF", "LOF"]))
    all_four = EN.blend(df, with_ae, "_with").withColumn("_has", F.col("score_ae").isNotNull())
    df = EN.blend(all_four, without, "_without").withColumn("score_ae", F.coalesce("score_ae", F.lit(0.0)))
    df = df.withColumn("ensemble_score", F.when(F.col("_has"), F.col("_with")).otherwise(F.col("_without"))).drop("_has", "_with", "_without")
    return EN.votes(EN.label(keep(df), by=by))


def perimeter_sweep(alarms: DataFrame, travellers: DataFrame, perimeters: list[dict],
                    key: str = "ROTTA") -> DataFrame:
    """The whole four-detector pipeline recomputed inside each perimeter (statistics and
    models are per perimeter, as for a single run); one row of tier counts per perimeter, zeros
    for one without routes.  The perimeter is a grouping key: records are tagged with every
    perimeter that holds them, and one set of jobs serves the whole list."""
    risk = perimeter_risk(alarms, travellers, perimeters, key)
    counts = risk.groupBy("perimeter_id").agg(F.count(F.lit(1)).alias("n_routes"),
                                              *[F.count_if(F.col("final_risk") == tt).alias(tt) for tt in K.RISK_TIERS])
    names = alarms.sparkSession.createDataFrame([(i, str(sorted(p.items()))) for i, p in enumerate(perimeters)],
                                                "perimeter_id int, perimeter string")
    return names.join(counts, "perimeter_id", "left").select(
        "perimeter_id", "perimeter", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_routes", *K.RISK_TIERS)])


def tagged(feed: DataFrame, perimeters: list[dict], out: str = "perimeter_id") -> DataFrame:
    """Every record once for each perimeter that holds it."""
    from lanewatch.operators.cleaning import perimeter_predicate
    inside = F.array(*[F.when(perimeter_predicate(p), F.lit(i)) for i, p in enumerate(perimeters)])
    return feed.select("*", F.explode(F.array_compact(inside)).alias(out))


def perimeter_risk(alarms: DataFrame, travellers: DataFrame, perimeters: list[dict], key: str = "ROTTA") -> DataFrame:
    """perimeter_id and the risk table of every perimeter."""
    by = ("perimeter_id",)
    feats = materialise(FT.entity_features(tagged(alarms, perimeters), tagged(travellers, perimeters), key, by))
    base = keep(B.label_by_quantiles(keep(B.robust_zscores_by(feats, by)), "baseline_score", "baseline_flag", by=by))
    return R.apply_rules(materialise(score_entities_by(base, by[0], key)))
