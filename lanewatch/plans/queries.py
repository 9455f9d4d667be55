"""Registered queries: each reads the driver tables and runs one operator family.

Importing this module fills ``catalog.QUERIES`` / ``catalog.ORACLE``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lanewatch import constants as K
from lanewatch.operators import features as FT
from lanewatch.plans import oracle_sql as O
from lanewatch.plans.catalog import register
from lanewatch.plans.workspace import memo
from lanewatch.sources import proxy

FEATURE_TYPES = ([("ROTTA", "str"), ("ZONA", "str"), ("PAESE_PART", "str")]
                 + [(c, "double") for c in FT.ALARM_NUMERIC + FT.TRAVELLER_NUMERIC]
                 + [(c, "str") for c in FT.TRAVELLER_CATEGORICAL] + [("score_composito", "double")])


@memo(persist=False)
def _features(spark, sf_dir, grain="nation"):
    return FT.entity_features(proxy.alarm_feed(spark, sf_dir, grain), proxy.traveller_feed(spark, sf_dir, grain))


# --------------------------------------------------------------------- features
@register("entity_features", O.with_(O.features_cte()) + O.round_select(FEATURE_TYPES, "features"))
def q_entity_features(spark, sf_dir):
    """One row per route with all features and the composite score."""
    return _features(spark, sf_dir).select(*[c for c, _ in FEATURE_TYPES])


from lanewatch.operators import baseline as B  # noqa: E402
from lanewatch.operators import rules as R  # noqa: E402
from lanewatch.plans.pipeline import score_entities  # noqa: E402
from lanewatch.session import keep  # noqa: E402

FEATS = K.BASELINE_FEATURES
FEAT_SQL = O.with_(O.features_cte())
BASE_SQL = O.with_(O.features_cte(), O.baseline_cte())
RISK_SQL = O.with_(O.features_cte(), O.baseline_cte(), O.zonly_scored_cte(), O.risk_cte())


@memo(persist=False)
def _baseline(spark, sf_dir):
    return B.robust_zscores(_features(spark, sf_dir))


@memo(persist=True)
def _risk_zonly(spark, sf_dir, classic: bool = False):
    """Pipeline with the Z detector only: every stage SQL-expressible."""
    f = _features(spark, sf_dir)
    if classic:
        f = B.classic_baseline(f).drop(*["z_" + c for c in FEATS])
    scored, _ = score_entities(B.robust_zscores(f), detectors=("Z",))
    return R.apply_rules(scored)


@register("feature_quality", FEAT_SQL + f"""SELECT CAST(count(*) AS BIGINT) AS n_rotte, {len(FT.ALARM_NUMERIC + FT.TRAVELLER_NUMERIC) + 1} AS n_features,
  CAST(0 AS BIGINT) AS null_totali,
  CAST({' + '.join(f'count_if({c} < 0)' for c in FT.ALARM_NUMERIC + FT.TRAVELLER_NUMERIC + ['score_composito'])} AS BIGINT) AS negativi_totali,
  round(round(avg(score_composito), 4), 6) AS score_mean, round(round(max(score_composito), 4), 6) AS score_max,
  round(round(min(score_composito), 4), 6) AS score_min,
  CAST(count_if(n_osservazioni_allarmi > 0 AND n_osservazioni_viag > 0) AS BIGINT) AS entrambi_dataset,
  CAST(count_if(n_osservazioni_allarmi > 0 AND n_osservazioni_viag = 0) AS BIGINT) AS solo_allarmi,
  CAST(count_if(n_osservazioni_allarmi = 0 AND n_osservazioni_viag > 0) AS BIGINT) AS solo_viaggiatori
FROM features""")
def q_feature_quality(spark, sf_dir):
    """Feature-table quality report."""
    return FT.feature_quality_report(_features(spark, sf_dir))


_STATS_COLS = [("feature", "str"), ("mean", "double"), ("std", "double"), ("median", "double"), ("q1", "double"),
               ("q3", "double"), ("iqr", "double"), ("p95", "double"), ("p99", "double"), ("tukey_upper", "double"),
               ("tukey_lower", "double"), ("z_upper", "double"), ("is_sparse", "int")]


def _stats_sql() -> str:
    parts = []
    for c in FEATS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT {O.q(c)} AS feature, avg({x}) AS mean, stddev_samp({x}) AS std,
  quantile_cont({x}, 0.5) AS median, quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3,
  quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) AS iqr, quantile_cont({x}, 0.95) AS p95,
  quantile_cont({x}, 0.99) AS p99,
  CASE WHEN quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) > 0
       THEN quantile_cont({x}, 0.75) + 1.5 * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25))
       ELSE quantile_cont({x}, 0.95) END AS tukey_upper,
  CASE WHEN quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) > 0
       THEN quantile_cont({x}, 0.25) - 1.5 * (quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)) END AS tukey_lower,
  avg({x}) + 2.5 * stddev_samp({x}) AS z_upper,
  CAST(quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) = 0 AS INTEGER) AS is_sparse FROM features""")
    return FEAT_SQL + ", stats AS (" + "\nUNION ALL\n".join(parts) + ")\n" + O.round_select(_STATS_COLS, "stats")


@register("baseline_stats", _stats_sql())
def q_baseline_stats(spark, sf_dir):
    """B1: per-feature baseline statistics (long format)."""
    return B.feature_stats(_features(spark, sf_dir))


_ROBUST_COLS = [("ROTTA", "str")] + [("z_" + c, "double") for c in FEATS] + [("baseline_score", "double"),
                                                                             ("baseline_flag", "str")]


@register("robust_baseline", O.with_(O.features_cte(), O.baseline_cte(),
                                     O.quantile_label_cte("baseline", "bl", "baseline_score", "baseline_flag"))
          + O.round_select(_ROBUST_COLS, "bl"))
def q_robust_baseline(spark, sf_dir):
    """Robust z per feature, baseline score, p97/p90 baseline flag."""
    b = B.label_by_quantiles(_baseline(spark, sf_dir), "baseline_score", "baseline_flag")
    return b.select(*[c for c, _ in _ROBUST_COLS])


def _robust_stats_sql() -> str:
    parts = []
    for i, c in enumerate(FEATS):
        x = f"coalesce(CAST({c} AS DOUBLE), 0.0)"
        parts.append(f"""SELECT {O.q(c)} AS feature, avg({x}) AS mean, stddev_samp({x}) AS std, max(med_{i}) AS median,
  quantile_cont(abs({x} - med_{i}), 0.5) AS mad FROM features, baseline_s1""")
    return (O.with_(O.features_cte(), O.baseline_cte()) + ", rs AS (" + "\nUNION ALL\n".join(parts) + ")\n"
            + O.round_select([("feature", "str"), ("mean", "double"), ("std", "double"), ("median", "double"),
                              ("mad", "double"), ("scale", "double")],
                             "(SELECT *, CASE WHEN mad > 0 THEN 1.4826 * mad WHEN std > 0 THEN std ELSE 0.0 END AS scale FROM rs)"))


@register("robust_stats", _robust_stats_sql())
def q_robust_stats(spark, sf_dir):
    """Mean, std, median, MAD and robust scale per feature."""
    return B.robust_stats(_features(spark, sf_dir))


def _classic_cte(src="features", out="classic") -> str:
    s = ", ".join(f"avg({c}) AS mean_{i}, stddev_samp({c}) AS std_{i}, quantile_cont({c}, 0.25) AS q1_{i}, "
                  f"quantile_cont({c}, 0.75) AS q3_{i}, quantile_cont({c}, 0.95) AS p95_{i}"
                  for i, c in enumerate(FEATS))
    z = ", ".join(f"({c} - mean_{i}) / (CASE WHEN std_{i} = 0 THEN 1.0 ELSE std_{i} END) AS z_{c}"
                  for i, c in enumerate(FEATS))
    fl = ", ".join(
        f"CAST(({c} > (CASE WHEN q3_{i} - q1_{i} > 0 THEN q3_{i} + 1.5 * (q3_{i} - q1_{i}) ELSE p95_{i} END)) "
        f"OR (z_{c} > 2.5) AS INTEGER) AS flag_{c}" for i, c in enumerate(FEATS))
    n = " + ".join(f"flag_{c}" for c in FEATS)
    return f"""{out}_s AS (SELECT {s} FROM {src}),
{out}_z AS (SELECT {src}.*, {out}_s.*, {z} FROM {src}, {out}_s),
{out}_f AS (SELECT *, {fl} FROM {out}_z),
{out} AS (SELECT *, {n} AS n_anomalie, round_even(({n}) / {float(len(FEATS))}, 4) AS pct_anomalie FROM {out}_f)"""


_CLASSIC_COLS = ([("ROTTA", "str")] + [("z_" + c, "double") for c in FEATS] + [("flag_" + c, "int") for c in FEATS]
                 + [("n_anomalie", "int"), ("pct_anomalie", "double")])


@register("classic_baseline", O.with_(O.features_cte(), _classic_cte()) + O.round_select(_CLASSIC_COLS, "classic"))
def q_classic_baseline(spark, sf_dir):
    """B2 + B6: classic z-scores, hybrid Tukey/z flags, anomaly counts."""
    return B.classic_baseline(_features(spark, sf_dir)).select(*[c for c, _ in _CLASSIC_COLS])


@register("baseline_report", O.with_(O.features_cte(), _classic_cte()) + "\nUNION ALL\n".join(
    f"SELECT {O.q(c)} AS feature, CAST(sum(flag_{c}) AS BIGINT) AS n_flagged, "
    f"round(round(sum(flag_{c}) * 100.0 / count(*), 2), 6) AS pct_flagged FROM classic" for c in FEATS))
def q_baseline_report(spark, sf_dir):
    """Entities flagged per feature."""
    return B.baseline_report(B.classic_baseline(_features(spark, sf_dir)))


@register("baseline_degeneracy", BASE_SQL + """SELECT CAST(count(*) AS BIGINT) AS n_entities, 13 AS n_features,
  round(stddev_samp(baseline_score), 6) AS score_std,
  (13 < 5 OR stddev_samp(baseline_score) IS NULL OR stddev_samp(baseline_score) < 0.01) AS is_degenerate FROM baseline""")
def q_baseline_degeneracy(spark, sf_dir):
    """Degenerate-baseline test (branch condition of the pipeline)."""
    return B.degeneracy(_baseline(spark, sf_dir))


_RISK_COLS = ([("ROTTA", "str"), ("PAESE_PART", "str"), ("ZONA", "str"), ("baseline_score", "double"),
               ("score_z", "double"), ("ensemble_score", "double"), ("anomaly_label", "str")]
              + [(n, "int") for n in K.RULE_LABELS]
              + [("br_score", "double"), ("confidence", "double"), ("final_risk", "str"), ("risk_drivers", "str")])


def _risk_out(df):
    return df.withColumn("risk_drivers", F.array_join("risk_drivers", " | ")).select(*[c for c, _ in _RISK_COLS])


@register("risk_tiers", RISK_SQL + O.round_select(_RISK_COLS, "risk"))
def q_risk_tiers(spark, sf_dir):
    """Flagship: routes -> robust baseline -> score -> p97/p90 labels -> rules -> tiers + drivers."""
    return _risk_out(_risk_zonly(spark, sf_dir))


_DIST_SQL = RISK_SQL + """SELECT CAST(d.ord AS INTEGER) AS ord, d.final_risk, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (VALUES (0, 'CRITICAL'), (1, 'HIGH'), (2, 'MEDIUM'), (3, 'LOW')) d(ord, final_risk)
LEFT JOIN (SELECT final_risk, count(*) AS n FROM risk GROUP BY final_risk) c ON c.final_risk = d.final_risk"""


@register("tier_distribution", _DIST_SQL)
def q_tier_distribution(spark, sf_dir):
    """Routes per risk tier, fixed order, zero-filled."""
    return R.tier_distribution(_risk_zonly(spark, sf_dir))


@register("rule_hits", RISK_SQL + "\nUNION ALL\n".join(
    f"SELECT {i} AS ord, {O.q(n)} AS rule, {O.q(K.RULE_LABELS[n])} AS label, CAST(sum({n}) AS BIGINT) AS n_hits FROM risk"
    for i, n in enumerate(K.RULE_LABELS)))
def q_rule_hits(spark, sf_dir):
    """Routes firing each business rule."""
    return R.rule_hits(_risk_zonly(spark, sf_dir))


_ALERT_COLS = [("ROTTA", "str"), ("final_risk", "str"), ("risk_num", "int"), ("confidence", "double"),
               ("ensemble_score", "double"), ("br_score", "double")]


@register("alert_list", RISK_SQL + O.round_select(_ALERT_COLS, """(SELECT *, CASE final_risk WHEN 'CRITICAL' THEN 4
  WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 END AS risk_num FROM risk
  WHERE final_risk IN ('CRITICAL', 'HIGH', 'MEDIUM') AND confidence >= 0.2)"""))
def q_alert_list(spark, sf_dir):
    """C28 + W6: alert routes (tier >= MEDIUM, confidence >= 0.20) by tier then confidence."""
    a = R.alerts(_risk_zonly(spark, sf_dir))
    return a.orderBy(F.desc("risk_num"), F.desc("confidence"), "ROTTA").select(*[c for c, _ in _ALERT_COLS])


_TIER_NUM = "CASE final_risk WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 END"
_TIER_LBL = "coalesce(CASE max_risk_num WHEN 4 THEN 'CRITICAL' WHEN 3 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 1 THEN 'LOW' END, 'LOW')"


@register("country_rollup", RISK_SQL + f"""SELECT PAESE_PART, CAST(count(ROTTA) AS BIGINT) AS n_rotte,
  CAST(count_if(final_risk IN ('CRITICAL','HIGH','MEDIUM')) AS BIGINT) AS n_alert,
  CAST(max({_TIER_NUM}) AS INTEGER) AS max_risk_num, round(max(confidence), 6) AS max_confidence,
  round(avg(confidence), 6) AS mean_confidence, round(sum(tot_allarmi_sum), 6) AS tot_allarmi,
  round(avg(pct_interpol), 6) AS mean_interpol, round(avg(score_rischio_esiti), 6) AS mean_esiti,
  {_TIER_LBL.replace('max_risk_num', f'max({_TIER_NUM})')} AS max_risk_label,
  round(round(count_if(final_risk IN ('CRITICAL','HIGH','MEDIUM')) / count(ROTTA), 3), 6) AS alert_rate
FROM risk WHERE PAESE_PART <> 'ND' GROUP BY PAESE_PART""")
def q_country_rollup(spark, sf_dir):
    """Risk roll-up per departure country."""
    return R.country_rollup(_risk_zonly(spark, sf_dir))


_ZONE_SQL_LABEL = ("CASE WHEN ZONA IS NULL OR ZONA IN ('ND', 'nan', '') OR TRY_CAST(ZONA AS DOUBLE) IS NULL "
                   "THEN 'Non classificata' ELSE coalesce(CASE CAST(TRY_CAST(ZONA AS DOUBLE) AS INTEGER) "
                   + " ".join(f"WHEN {k} THEN {O.q(v)}" for k, v in R.ZONE_LABELS.items())
                   + " END, 'Zona ' || CAST(CAST(TRY_CAST(ZONA AS DOUBLE) AS INTEGER) AS VARCHAR)) END")


@register("zone_rollup", RISK_SQL + f"""SELECT zona_label, CAST(count(ROTTA) AS BIGINT) AS n_rotte,
  CAST(count_if(final_risk IN ('CRITICAL','HIGH','MEDIUM')) AS BIGINT) AS n_alert,
  round(max(confidence), 6) AS max_confidence, round(avg(confidence), 6) AS mean_confidence,
  CAST(max({_TIER_NUM}) AS INTEGER) AS max_risk_num,
  round(round(count_if(final_risk IN ('CRITICAL','HIGH','MEDIUM')) / count(ROTTA), 3), 6) AS alert_rate,
  {_TIER_LBL.replace('max_risk_num', f'max({_TIER_NUM})')} AS max_risk_label
FROM (SELECT *, {_ZONE_SQL_LABEL} AS zona_label FROM risk) GROUP BY zona_label""")
def q_zone_rollup(spark, sf_dir):
    """Risk roll-up per geographic zone label."""
    return R.zone_rollup(_risk_zonly(spark, sf_dir))


@register("alert_summary", RISK_SQL + """SELECT CAST(count(*) AS BIGINT) AS n_total,
  CAST(count_if(final_risk = 'CRITICAL') AS BIGINT) AS n_critical, CAST(count_if(final_risk = 'HIGH') AS BIGINT) AS n_high,
  CAST(count_if(final_risk = 'MEDIUM') AS BIGINT) AS n_medium, CAST(count_if(final_risk = 'LOW') AS BIGINT) AS n_low,
  CAST(count_if(final_risk IN ('CRITICAL','HIGH','MEDIUM')) AS BIGINT) AS n_alert,
  round(round(count_if(final_risk IN ('CRITICAL','HIGH','MEDIUM')) * 100.0 / count(*), 2), 6) AS alert_rate_pct,
  round(avg(CASE WHEN final_risk IN ('CRITICAL','HIGH','MEDIUM') AND confidence >= 0.2 THEN confidence END), 6) AS mean_confidence_alert,
  round(max(confidence), 6) AS max_confidence,
  arg_min(ROTTA, (-confidence, ROTTA)) AS top_route, arg_min(PAESE_PART, (-confidence, ROTTA)) AS top_country,
  CAST(count_if(confidence > 0.5) AS BIGINT) AS n_conf_gt_50, CAST(count_if(confidence > 0.4) AS BIGINT) AS n_conf_gt_40,
  CAST(count_if(confidence > 0.3) AS BIGINT) AS n_conf_gt_30 FROM risk""")
def q_alert_summary(spark, sf_dir):
    """Alert summary with the top route and country."""
    return R.alert_summary(_risk_zonly(spark, sf_dir))


# -------------------------------------------------------------------- detectors
from lanewatch.operators.detectors import autoencoder as AEm  # noqa: E402
from lanewatch.operators.detectors import ensemble as EN  # noqa: E402
from lanewatch.operators.detectors import iforest as IFm  # noqa: E402
from lanewatch.operators.detectors import lof as LOFm  # noqa: E402
from lanewatch.operators.detectors.scaling import standard_scale  # noqa: E402
from lanewatch.plans.pipeline import risk_pipeline  # noqa: E402


@memo(persist=True)
def _scaled(spark, sf_dir):
    return standard_scale(_features(spark, sf_dir).select("ROTTA", *FEATS), FEATS)


@register("standardized_features", O.with_(O.features_cte(), O.scaled_cte())
          + O.round_select([("ROTTA", "str")] + [(c, "double") for c in FEATS], "scaled"))
def q_standardized_features(spark, sf_dir):
    """D1 + D2: 13-feature model matrix, standard-scaled with population std."""
    return _scaled(spark, sf_dir)


@register("lof_scores", O.with_(O.features_cte(), O.scaled_cte(), O.lof_cte())
          + O.round_select([("ROTTA", "str"), ("lof", "double"), ("score_lof", "double")], "lof"))
def q_lof_scores(spark, sf_dir):
    """D4 + D7: exact LOF (k = 20, Euclidean) on the scaled matrix and its min-max score."""
    lof = keep(LOFm.local_outlier_factor(_scaled(spark, sf_dir), FEATS, k=K.N_NEIGHBORS))
    return EN.minmax(lof, {"score_lof": "lof"})


IF_SQL = O.with_(O.features_cte(), O.scaled_cte(), O.iforest_cte("scaled", "forest"))


@register("iforest_scores", IF_SQL + f""", q AS (SELECT quantile_cont(if_score, 0.9) AS t FROM forest)
SELECT ROTTA, round(if_score, 6) AS if_score, if_score <= t AS if_normal,
  round({O.minmax_expr('if_score', 'forest')}, 6) AS score_if FROM forest, q""")
def q_iforest_scores(spark, sf_dir):
    """D3 + D7: isolation forest (200 trees, psi = 256) score, min-max score, inlier flag."""
    sc = keep(_scaled(spark, sf_dir))
    forest = IFm.fit(sc, FEATS, n_trees=K.N_TREES, max_samples=K.MAX_SAMPLES, seed=K.RANDOM_STATE)
    s = keep(IFm.with_prediction(keep(IFm.score(sc, forest, FEATS)), K.CONTAMINATION))
    return EN.minmax(s, {"score_if": "if_score"})


@register("autoencoder_scores")
def q_autoencoder_scores(spark, sf_dir):
    """Autoencoder trained on forest inliers; min-max reconstruction error."""
    sc = keep(_scaled(spark, sf_dir))
    forest = IFm.fit(sc, FEATS, n_trees=K.N_TREES, max_samples=K.MAX_SAMPLES, seed=K.RANDOM_STATE)
    s = keep(IFm.with_prediction(keep(IFm.score(sc, forest, FEATS)), K.CONTAMINATION))
    ae = AEm.autoencoder_scores(sc.join(s.select("ROTTA", "if_normal"), on="ROTTA"), FEATS)
    if ae is None:
        return sc.select("ROTTA", F.lit(0.0).alias("score_ae"))
    return ae


@memo(persist=False)
def _full(spark, sf_dir):
    return risk_pipeline(proxy.alarm_feed(spark, sf_dir), proxy.traveller_feed(spark, sf_dir))


_FULL_COLS = ["ROTTA", "PAESE_PART", "ZONA", "score_if", "score_lof", "score_z", "score_ae", "ensemble_score",
              "anomaly_label", "n_models_flagged", *K.RULE_LABELS, "br_score", "confidence", "final_risk",
              "risk_drivers"]


@register("risk_pipeline_full")
def q_risk_pipeline_full(spark, sf_dir):
    """D2–D11 + R1–R9: four-detector ensemble, labels, votes, rules, tiers."""
    r = _full(spark, sf_dir).risk
    return r.withColumn("risk_drivers", F.array_join("risk_drivers", " | ")).select(*_FULL_COLS)


# --------------------------------------------------------------------- cleaning
from lanewatch.operators import cleaning as CL  # noqa: E402
from lanewatch.plans import oracle_clean as OC  # noqa: E402

_CLEAN_A_COLS = [("_rid", "bigint"), ("AREOPORTO_ARRIVO", "str"), ("AREOPORTO_PARTENZA", "str"),
                 ("ANNO_PARTENZA", "double"), ("MESE_PARTENZA", "int"), ("DATA_PARTENZA", "str"), ("TOT", "double"),
                 ("ZONA", "int"), ("OCCORRENZE", "str"), ("CODICE_PAESE_ARR", "str"), ("CODICE_PAESE_PART", "str"),
                 ("PAESE_ARR", "str"), ("PAESE_PART", "str"), ("MOTIVO_ALLARME", "str"), ("ora_partenza", "int"),
                 ("giorno_settimana", "int"), ("mese", "int")]
_CLEAN_T_COLS = [("_rid", "bigint"), ("AREOPORTO_ARRIVO", "str"), ("AREOPORTO_PARTENZA", "str"),
                 ("ANNO_PARTENZA", "double"), ("MESE_PARTENZA", "int"), ("DATA_PARTENZA", "str"),
                 ("ENTRATI", "double"), ("INVESTIGATI", "double"), ("ALLARMATI", "double"), ("GENERE", "str"),
                 ("TIPO_DOCUMENTO", "str"), ("FASCIA_ETA", "str"), ("NAZIONALITA", "str"), ("ESITO_CONTROLLO", "str"),
                 ("COMPAGNIA_AEREA", "str"), ("ZONA", "int"), ("PAESE_PART", "str"), ("tasso_allarme", "double"),
                 ("tasso_investigati", "double"), ("ora_partenza", "int"), ("giorno_settimana", "int"), ("mese", "int")]


def _ts_str(df):
    return df.withColumn("DATA_PARTENZA", F.date_format("DATA_PARTENZA", "yyyy-MM-dd HH:mm:ss"))


def _ts_sql(cols, src):
    return O.round_select(cols, f"(SELECT * REPLACE (strftime(DATA_PARTENZA, '%Y-%m-%d %H:%M:%S') AS DATA_PARTENZA) FROM {src})")


@memo(persist=False)
def _clean_a(spark, sf_dir):
    return CL.clean_alarms(proxy.raw_alarm_feed(spark, sf_dir))


@memo(persist=False)
def _clean_t(spark, sf_dir):
    return CL.clean_travellers(proxy.raw_traveller_feed(spark, sf_dir))


@register("clean_alarms", O.with_(O.alarms_cte(), O.travellers_cte(), OC.raw_alarms_cte(), OC.clean_alarms_cte())
          + _ts_sql(_CLEAN_A_COLS, "clean_alarms"))
def q_clean_alarms(spark, sf_dir):
    """C1–C8, C11, C13, C15, C16, C18, C21 over the dirty alarm records."""
    return _ts_str(_clean_a(spark, sf_dir)).select(*[c for c, _ in _CLEAN_A_COLS])


@register("clean_travellers", O.with_(O.alarms_cte(), O.travellers_cte(), OC.raw_travellers_cte(),
                                      OC.clean_travellers_cte()) + _ts_sql(_CLEAN_T_COLS, "clean_travellers"))
def q_clean_travellers(spark, sf_dir):
    """C1–C6, C9–C12, C14–C21 over the dirty traveller records."""
    return _ts_str(_clean_t(spark, sf_dir)).select(*[c for c, _ in _CLEAN_T_COLS])


_MERGED_COLS = [("_rid", "bigint"), ("AREOPORTO_ARRIVO", "str"), ("AREOPORTO_PARTENZA", "str"), ("TOT", "double"),
                ("tot_entrati", "double"), ("tot_allarmati", "double"), ("tot_investigati", "double"),
                ("tasso_allarme_volo", "double"), ("tasso_inv_volo", "double"), ("n_nazionalita", "bigint"),
                ("n_respinti", "bigint"), ("n_fermati", "bigint"), ("n_segnalati", "bigint")]


@register("merged_feed", O.with_(O.alarms_cte(), O.travellers_cte(), OC.raw_alarms_cte(), OC.clean_alarms_cte(),
                                 OC.raw_travellers_cte(), OC.clean_travellers_cte()) + O.round_select(_MERGED_COLS, """(
  SELECT a.*, t.* EXCLUDE (AREOPORTO_ARRIVO, AREOPORTO_PARTENZA, k) FROM (SELECT *, CAST(DATA_PARTENZA AS DATE) AS k FROM clean_alarms) a
  LEFT JOIN (SELECT AREOPORTO_ARRIVO, AREOPORTO_PARTENZA, CAST(DATA_PARTENZA AS DATE) AS k,
      sum(ENTRATI) AS tot_entrati, sum(ALLARMATI) AS tot_allarmati, sum(INVESTIGATI) AS tot_investigati,
      avg(tasso_allarme) AS tasso_allarme_volo, avg(tasso_investigati) AS tasso_inv_volo,
      count(DISTINCT NAZIONALITA) AS n_nazionalita, count_if(ESITO_CONTROLLO = 'RESPINTO') AS n_respinti,
      count_if(ESITO_CONTROLLO = 'FERMATO') AS n_fermati, count_if(ESITO_CONTROLLO = 'SEGNALATO') AS n_segnalati
    FROM clean_travellers WHERE AREOPORTO_ARRIVO IS NOT NULL AND AREOPORTO_PARTENZA IS NOT NULL AND DATA_PARTENZA IS NOT NULL
    GROUP BY ALL) t
  ON a.AREOPORTO_ARRIVO = t.AREOPORTO_ARRIVO AND a.AREOPORTO_PARTENZA = t.AREOPORTO_PARTENZA AND a.k = t.k)"""))
def q_merged_feed(spark, sf_dir):
    """J1 + A1: alarms LEFT JOIN per (arrival, departure, day) traveller aggregates."""
    from lanewatch.operators.features import merge_feeds
    wanted = [c for c, _ in _MERGED_COLS]
    alarms, travellers = _clean_a(spark, sf_dir), _clean_t(spark, sf_dir)
    keys = ["AREOPORTO_ARRIVO", "AREOPORTO_PARTENZA", "DATA_PARTENZA"]
    # only the columns that the merge reads
    a = alarms.select(*[c for c in alarms.columns if c in wanted or c in keys])
    t = travellers.select(*keys, "ENTRATI", "ALLARMATI", "INVESTIGATI", "tasso_allarme", "tasso_investigati", "NAZIONALITA",
                          "ESITO_CONTROLLO")
    return merge_feeds(a, t).select(*wanted)


@register("null_report", O.with_(O.alarms_cte(), O.travellers_cte(), OC.raw_alarms_cte(), OC.clean_alarms_cte())
          + "\nUNION ALL\n".join(
              f"SELECT {i} AS ord, {O.q(c)} AS column, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null, "
              f"round(round(count_if({c} IS NULL) * 100.0 / count(*), 2), 6) AS pct_null FROM clean_alarms"
              for i, (c, _) in enumerate(_CLEAN_A_COLS)))
def q_null_report(spark, sf_dir):
    """A16 (+ the C22 drop decision input): null count and percent per cleaned column."""
    return CL.null_fractions(_clean_a(spark, sf_dir).select(*[c for c, _ in _CLEAN_A_COLS]))


@register("value_counts", O.with_(O.alarms_cte(), O.travellers_cte(), OC.raw_travellers_cte(),
                                  OC.clean_travellers_cte())
          + """SELECT COMPAGNIA_AEREA, CAST(count(*) AS BIGINT) AS n FROM clean_travellers WHERE COMPAGNIA_AEREA IS NOT NULL
GROUP BY COMPAGNIA_AEREA ORDER BY n DESC, COMPAGNIA_AEREA LIMIT 30""")
def q_value_counts(spark, sf_dir):
    """Top-30 airline values with counts (a top-k report)."""
    return CL.value_counts(_clean_t(spark, sf_dir), "COMPAGNIA_AEREA", 30)


_DIMS = ["AREOPORTO_PARTENZA", "AREOPORTO_ARRIVO", "PAESE_PART", "ZONA", "ANNO_PARTENZA"]


@register("filter_options", O.with_(O.alarms_cte(), O.travellers_cte(), OC.raw_alarms_cte(), OC.clean_alarms_cte())
          + "\nUNION\n".join(f"SELECT {O.q(d)} AS dimension, CAST({d} AS VARCHAR) AS value FROM clean_alarms "
                             f"WHERE {d} IS NOT NULL" for d in _DIMS if d != "ANNO_PARTENZA")
          + "\nUNION\nSELECT 'ANNO_PARTENZA' AS dimension, CAST(ANNO_PARTENZA AS VARCHAR) FROM clean_alarms WHERE ANNO_PARTENZA IS NOT NULL")
def q_filter_options(spark, sf_dir):
    """Distinct values per filter dimension."""
    return CL.filter_options(_clean_a(spark, sf_dir), _DIMS)


PERIMETER_JAN97 = {"anno": 1997, "mese": 1}


def _perimeter_features(spark, sf_dir, perimeter):
    a = CL.apply_perimeter(proxy.alarm_feed(spark, sf_dir), perimeter)
    t = CL.apply_perimeter(proxy.traveller_feed(spark, sf_dir), perimeter)
    return FT.entity_features(a, t)


_PERIM_ALARMS = O.alarms_cte().replace("alarms AS (", "alarms AS (SELECT * FROM (", 1) + \
    " WHERE ANNO_PARTENZA = 1997 AND MESE_PARTENZA = 1)"
_PERIM_TRAV = O.travellers_cte().replace("travellers AS (", "travellers AS (SELECT * FROM (", 1) + \
    " WHERE ANNO_PARTENZA = 1997 AND MESE_PARTENZA = 1)"


@register("perimeter_features", O.with_(O.features_cte(_PERIM_ALARMS, _PERIM_TRAV))
          + O.round_select(FEATURE_TYPES, "features"))
def q_perimeter_features(spark, sf_dir):
    """C24 + J2 + J4: feature table inside a perimeter (January 1997): routes present in only
    one feed exercise the full outer join, the country/zone fallbacks and sparse features."""
    return _perimeter_features(spark, sf_dir, PERIMETER_JAN97).select(*[c for c, _ in FEATURE_TYPES])


# -------------------------------------------------------------------- profiling
from lanewatch.operators import profile as PR  # noqa: E402

FEEDS_SQL = O.with_(O.alarms_cte(), O.travellers_cte())
CLEAN_T_SQL = O.with_(O.alarms_cte(), O.travellers_cte(), OC.raw_travellers_cte(), OC.clean_travellers_cte())
_TRAV_NUM = ["ENTRATI", "INVESTIGATI", "ALLARMATI"]


def _alarms(spark, sf_dir):
    return proxy.alarm_feed(spark, sf_dir)


def _trav(spark, sf_dir):
    return proxy.traveller_feed(spark, sf_dir)


@register("dataset_stats", FEEDS_SQL + """SELECT CAST(count(*) AS BIGINT) AS n_righe,
  CAST(count(DISTINCT ROTTA) AS BIGINT) AS n_rotte_uniche, CAST(count(DISTINCT AREOPORTO_PARTENZA) AS BIGINT) AS n_aeroporti_part,
  CAST(count(DISTINCT AREOPORTO_ARRIVO) AS BIGINT) AS n_aeroporti_arr, CAST(count(DISTINCT PAESE_ARR) AS BIGINT) AS n_paesi_arr,
  (SELECT string_agg(y, ',' ORDER BY y) FROM (SELECT DISTINCT CAST(CAST(ANNO_PARTENZA AS INTEGER) AS VARCHAR) AS y
     FROM alarms WHERE ANNO_PARTENZA IS NOT NULL)) AS anni_presenti,
  (SELECT string_agg(PAESE_PART, ',' ORDER BY n DESC, PAESE_PART) FROM (SELECT PAESE_PART, count(*) AS n FROM alarms
     WHERE PAESE_PART IS NOT NULL GROUP BY PAESE_PART ORDER BY n DESC, PAESE_PART LIMIT 5)) AS paesi_partenza_top5,
  CAST(count_if(coalesce(CAST(TOT AS DOUBLE), 0.0) > 0) AS BIGINT) AS n_con_allarmi FROM alarms""")
def q_dataset_stats(spark, sf_dir):
    """Rows, distinct routes, airports and countries, years, top-5 departure countries, rows with alarms."""
    return PR.dataset_stats(_alarms(spark, sf_dir))


@register("outcome_rates", FEEDS_SQL + """, n AS (SELECT ROTTA, """ + ", ".join(
    f"count_if(ESITO_CONTROLLO = {O.q(v)}) AS {c}" for v, c in K.OUTCOME_COLUMNS.items()) + """ FROM travellers
  WHERE ROTTA IS NOT NULL GROUP BY ROTTA),
r AS (SELECT ROTTA, """ + " + ".join(K.OUTCOME_COLUMNS.values()) + """ AS total, n_respinti, n_fermati FROM n),
x AS (SELECT ROTTA, CASE WHEN total > 0 THEN n_respinti / total ELSE 0.0 END AS a, CASE WHEN total > 0 THEN n_fermati / total ELSE 0.0 END AS b FROM r)
SELECT ROTTA, round(a, 6) AS tasso_respinti, round(b, 6) AS tasso_fermati,
  round(least(greatest(a * 0.6 + b * 0.4, 0), 1), 6) AS score_rischio_esiti FROM x""")
def q_outcome_rates(spark, sf_dir):
    """Outcome rates per route over all outcomes (the feature table divides by observations)."""
    t = FT.traveller_entity_aggregate(proxy.traveller_feed(spark, sf_dir), denominator="outcomes")
    return t.select("ROTTA", "tasso_respinti", "tasso_fermati", "score_rischio_esiti")


def _describe_sql(cols, src):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT {O.q(c)} AS column, CAST(count({x}) AS BIGINT) AS count, round(avg({x}), 2) AS mean,
  round(stddev_samp({x}), 2) AS std, round(min({x}), 2) AS min, round(quantile_cont({x}, 0.25), 2) AS p25,
  round(quantile_cont({x}, 0.5), 2) AS p50, round(quantile_cont({x}, 0.75), 2) AS p75, round(max({x}), 2) AS max,
  round(skewness({x}), 2) AS skewness, round(kurtosis({x}), 2) AS kurtosis FROM {src}""")
    return "\nUNION ALL\n".join(parts)


@register("describe_travellers", FEEDS_SQL + _describe_sql(_TRAV_NUM, "travellers"))
def q_describe_travellers(spark, sf_dir):
    """Describe + bias-corrected skewness / excess kurtosis of the traveller counters."""
    return PR.describe(_trav(spark, sf_dir), _TRAV_NUM)


@register("correlation_matrix", FEEDS_SQL + "\nUNION ALL\n".join(
    f"SELECT {O.q(a)} AS a, {O.q(b)} AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS r FROM travellers"
    for a in _TRAV_NUM for b in _TRAV_NUM))
def q_correlation_matrix(spark, sf_dir):
    """Pearson correlation matrix of the traveller counters."""
    return PR.correlation_matrix(_trav(spark, sf_dir), _TRAV_NUM)


_RATE_DIMS = ["GENERE", "FASCIA_ETA", "TIPO_DOCUMENTO", "NAZIONALITA", "ZONA"]


@register("rate_by_dimension", FEEDS_SQL + "\nUNION ALL\n".join(
    f"""SELECT {O.q(d)} AS dimension, CAST({d} AS VARCHAR) AS value, round(sum(ENTRATI), 6) AS entrati,
  round(sum(ALLARMATI), 6) AS allarmati,
  round(CASE WHEN sum(ENTRATI) > 0 THEN sum(ALLARMATI) / sum(ENTRATI) END, 6) AS alarm_rate
  FROM travellers WHERE {d} IS NOT NULL GROUP BY {d}""" for d in _RATE_DIMS))
def q_rate_by_dimension(spark, sf_dir):
    """Alarm rate (ratio of sums) per value of five dimensions in one shuffle."""
    return PR.rate_by(_trav(spark, sf_dir), _RATE_DIMS)


# ---------------------------------------------------------------- FIXED VALUES
UNRESOLVED_CODES = ["ND", "XX", "???", "UNK", "UNKN", "EU", "ZZ"]
AGE_ORDER = ["0-17", "18-30", "31-45", "46-60", "61+"]
# ------------------------------------------------------------ END FIXED VALUES


@register("top_nationality_rates", FEEDS_SQL + f"""SELECT NAZIONALITA, round(sum(ENTRATI), 6) AS entrati,
  round(sum(ALLARMATI), 6) AS allarmati, round(sum(ALLARMATI) / sum(ENTRATI), 6) AS alarm_rate
FROM travellers WHERE NAZIONALITA IS NOT NULL AND NAZIONALITA NOT IN ({', '.join(O.q(c) for c in UNRESOLVED_CODES)})
GROUP BY NAZIONALITA HAVING sum(ENTRATI) >= 30 ORDER BY alarm_rate DESC, NAZIONALITA LIMIT 20""")
def q_top_nationality_rates(spark, sf_dir):
    """Nationality alarm rates with a minimum volume of 30, top 20 (a top-k report)."""
    return PR.top_rates(_trav(spark, sf_dir), "NAZIONALITA", 30, UNRESOLVED_CODES, 20)


@register("gender_age_rates", CLEAN_T_SQL + "SELECT GENERE, " + ", ".join(
    f"round(CASE WHEN sum(CASE WHEN FASCIA_ETA = {O.q(a)} THEN ENTRATI END) > 0 THEN "
    f"sum(CASE WHEN FASCIA_ETA = {O.q(a)} THEN ALLARMATI END) / sum(CASE WHEN FASCIA_ETA = {O.q(a)} THEN ENTRATI END) END, 6) AS \"{a}\""
    for a in AGE_ORDER) + " FROM clean_travellers WHERE GENERE IS NOT NULL AND FASCIA_ETA IS NOT NULL GROUP BY GENERE")
def q_gender_age_rates(spark, sf_dir):
    """Gender x age-band alarm-rate cross-tab over the cleaned traveller feed."""
    return PR.cross_tab_rate(_clean_t(spark, sf_dir), "GENERE", "FASCIA_ETA", AGE_ORDER)


@register("outcome_frequency", FEEDS_SQL + """SELECT ESITO_CONTROLLO, CAST(count(*) AS BIGINT) AS n,
  round(round(count(*) * 100.0 / sum(count(*)) OVER (), 1), 6) AS pct FROM travellers
WHERE ESITO_CONTROLLO IS NOT NULL GROUP BY ESITO_CONTROLLO""")
def q_outcome_frequency(spark, sf_dir):
    """Frequency and percentage of control outcomes."""
    return PR.frequency(_trav(spark, sf_dir), "ESITO_CONTROLLO")


@register("monthly_trend", FEEDS_SQL + """SELECT CAST(month(DATA_PARTENZA) AS INTEGER) AS mese,
  round(sum(ENTRATI), 6) AS ENTRATI, round(sum(INVESTIGATI), 6) AS INVESTIGATI, round(sum(ALLARMATI), 6) AS ALLARMATI
FROM travellers WHERE DATA_PARTENZA IS NOT NULL GROUP BY 1""")
def q_monthly_trend(spark, sf_dir):
    """Monthly sums of the traveller counters."""
    return PR.monthly_trend(_trav(spark, sf_dir), _TRAV_NUM)


@register("monthly_volume", FEEDS_SQL + """SELECT month, CAST(coalesce(sum(CASE WHEN feed = 'alarms' THEN 1 END), 0) AS BIGINT) AS alarms,
  CAST(coalesce(sum(CASE WHEN feed = 'travellers' THEN 1 END), 0) AS BIGINT) AS travellers FROM (
  SELECT strftime(DATA_PARTENZA, '%Y-%m') AS month, 'alarms' AS feed FROM alarms
  UNION ALL SELECT strftime(DATA_PARTENZA, '%Y-%m'), 'travellers' FROM travellers) WHERE month IS NOT NULL GROUP BY month""")
def q_monthly_volume(spark, sf_dir):
    """Rows per month of the two feeds side by side."""
    return PR.monthly_volume(_alarms(spark, sf_dir), _trav(spark, sf_dir))


@register("top_countries_volume", FEEDS_SQL + """SELECT PAESE_PART, round(sum(TOT), 6) AS volume FROM alarms
WHERE PAESE_PART IS NOT NULL GROUP BY PAESE_PART ORDER BY volume DESC, PAESE_PART LIMIT 10""")
def q_top_countries_volume(spark, sf_dir):
    """Top-10 departure countries by summed (cleaned, numeric) alarm volume."""
    return PR.top_by_sum(_alarms(spark, sf_dir), "PAESE_PART", "TOT", 10)


@register("label_tier_confusion", RISK_SQL + """SELECT anomaly_label AS label_a, final_risk AS label_b,
  CAST(count(*) AS BIGINT) AS n, round(round(count(*) * 100.0 / (SELECT count(*) FROM risk), 2), 6) AS pct
FROM risk GROUP BY 1, 2""")
def q_label_tier_confusion(spark, sf_dir):
    """Cross-tab of the anomaly labelling against the final tiers."""
    return PR.confusion(_risk_zonly(spark, sf_dir), "anomaly_label", "final_risk")


@register("group_contrast", RISK_SQL + "\nUNION ALL\n".join(
    f"""SELECT {O.q(c)} AS feature, round(avg(CASE WHEN anomaly_label = 'HIGH' THEN {c} END), 6) AS mean_anomalous,
  round(avg(CASE WHEN anomaly_label <> 'HIGH' THEN {c} END), 6) AS mean_normal,
  round(CASE WHEN avg(CASE WHEN anomaly_label <> 'HIGH' THEN {c} END) <> 0 THEN
    avg(CASE WHEN anomaly_label = 'HIGH' THEN {c} END) / avg(CASE WHEN anomaly_label <> 'HIGH' THEN {c} END) END, 6) AS ratio,
  coalesce(avg(CASE WHEN anomaly_label = 'HIGH' THEN {c} END) / nullif(avg(CASE WHEN anomaly_label <> 'HIGH' THEN {c} END), 0) >= 2, false) AS is_2x
FROM risk""" for c in FEATS))
def q_group_contrast(spark, sf_dir):
    """Feature means in HIGH vs other routes, ratio and 2x flag."""
    return PR.group_contrast(_risk_zonly(spark, sf_dir), F.col("anomaly_label") == "HIGH", FEATS)


@register("observability", FEAT_SQL + """SELECT n_osservazioni_viag < 30 AS low_observability, CAST(count(*) AS BIGINT) AS n,
  round(avg(score_composito), 6) AS mean, round(stddev_samp(score_composito), 6) AS std, round(min(score_composito), 6) AS min,
  round(quantile_cont(score_composito, 0.25), 6) AS p25, round(quantile_cont(score_composito, 0.5), 6) AS p50,
  round(quantile_cont(score_composito, 0.75), 6) AS p75, round(max(score_composito), 6) AS max FROM features GROUP BY 1""")
def q_observability(spark, sf_dir):
    """Low-observability flag (< 30 traveller rows) and score summary per group."""
    return PR.observability(_features(spark, sf_dir))


@register("quantile_trim", FEEDS_SQL + """SELECT _rid, round(ENTRATI, 6) AS ENTRATI FROM travellers
WHERE ENTRATI <= (SELECT quantile_cont(ENTRATI, 0.99) FROM travellers)""")
def q_quantile_trim(spark, sf_dir):
    """Traveller rows at or below the p99 of ENTRATI."""
    return PR.quantile_trim(_trav(spark, sf_dir), "ENTRATI", 0.99).select("_rid", "ENTRATI")


def _hist_sql(src, col, bins, group=None):
    g = f"{group} AS grp, " if group else ""
    gk = "grp, " if group else ""
    dom = (f"(SELECT DISTINCT {group} AS grp FROM {src} WHERE {group} IS NOT NULL) gg, range({bins}) r(bin)" if group
           else f"range({bins}) r(bin)")
    return f"""h_st AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {src}),
h_c AS (SELECT {g}CASE WHEN hi > lo THEN least(CAST(floor(({col} - lo) / ((hi - lo) / {float(bins)})) AS INTEGER), {bins - 1}) ELSE 0 END AS bin,
  count(*) AS n FROM {src}, h_st WHERE {col} IS NOT NULL GROUP BY ALL)
SELECT {'d.grp, ' if group else ''}CAST(d.bin AS INTEGER) AS bin, round(lo + d.bin * ((hi - lo) / {float(bins)}), 6) AS lo,
  round(lo + (d.bin + 1) * ((hi - lo) / {float(bins)}), 6) AS hi, CAST(coalesce(h_c.n, 0) AS BIGINT) AS n
FROM (SELECT {gk}bin FROM {dom}) d CROSS JOIN h_st LEFT JOIN h_c ON h_c.bin = d.bin{' AND h_c.grp = d.grp' if group else ''}"""


@register("score_histogram", RISK_SQL + ", " + _hist_sql("risk", "ensemble_score", 30, "anomaly_label"))
def q_score_histogram(spark, sf_dir):
    """30 equal-width bins of the ensemble score, per anomaly label, zero-filled."""
    return PR.histogram(_risk_zonly(spark, sf_dir), "ensemble_score", 30, group="anomaly_label")


@register("box_summary", FEEDS_SQL + """, q AS (SELECT ESITO_CONTROLLO, quantile_cont(ENTRATI, 0.25) AS q1,
  quantile_cont(ENTRATI, 0.5) AS median, quantile_cont(ENTRATI, 0.75) AS q3 FROM travellers GROUP BY 1)
SELECT t.ESITO_CONTROLLO, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(CASE WHEN ENTRATI >= q1 - 1.5 * (q3 - q1) AND ENTRATI <= q3 + 1.5 * (q3 - q1) THEN ENTRATI END), 6) AS whisker_lo,
  round(max(CASE WHEN ENTRATI >= q1 - 1.5 * (q3 - q1) AND ENTRATI <= q3 + 1.5 * (q3 - q1) THEN ENTRATI END), 6) AS whisker_hi,
  CAST(count_if(NOT (ENTRATI >= q1 - 1.5 * (q3 - q1) AND ENTRATI <= q3 + 1.5 * (q3 - q1))) AS BIGINT) AS n_outliers
FROM travellers t JOIN q ON t.ESITO_CONTROLLO = q.ESITO_CONTROLLO GROUP BY t.ESITO_CONTROLLO, q1, median, q3""")
def q_box_summary(spark, sf_dir):
    """Box-plot summary of ENTRATI per control outcome."""
    return PR.box_summary(_trav(spark, sf_dir), "ENTRATI", "ESITO_CONTROLLO")


@register("least_squares", FEEDS_SQL + """SELECT round(regr_slope(ALLARMATI, ENTRATI), 6) AS slope,
  round(regr_intercept(ALLARMATI, ENTRATI), 6) AS intercept, round(regr_r2(ALLARMATI, ENTRATI), 6) AS r2 FROM travellers""")
def q_least_squares(spark, sf_dir):
    """Least-squares line of ALLARMATI on ENTRATI."""
    return PR.least_squares(_trav(spark, sf_dir), "ALLARMATI", "ENTRATI")


_SAMPLE_COLS = ["TOT", "ZONA", "OCCORRENZE", "CODICE_PAESE_PART"]


@register("column_samples", O.with_(O.alarms_cte(), O.travellers_cte(), OC.raw_alarms_cte(), OC.clean_alarms_cte())
          + "\nUNION ALL\n".join(
              f"(SELECT {O.q(c)} AS column, CAST(_rid AS BIGINT) AS row_id, CAST({c} AS VARCHAR) AS value "
              f"FROM clean_alarms WHERE {c} IS NOT NULL ORDER BY _rid LIMIT 3)" for c in _SAMPLE_COLS))
def q_column_samples(spark, sf_dir):
    """First three non-null values per cleaned column."""
    return PR.column_samples(_clean_a(spark, sf_dir), _SAMPLE_COLS)


# ------------------------------------------------------------ ranks & compare
from lanewatch.operators import compare as CMP  # noqa: E402
from lanewatch.operators import ranks as RK  # noqa: E402


@memo(persist=True)
def _aligned(spark, sf_dir):
    """Run A: robust-baseline ensemble labels; run B: composite-score labels (p97/p90)."""
    risk = _risk_zonly(spark, sf_dir)
    b = B.label_by_quantiles(risk.select("ROTTA", "score_composito"), "score_composito", "label_b")
    return CMP.align(risk, b, "ROTTA", {"score_a": "ensemble_score", "label_a": "anomaly_label"},
                     {"score_b": "score_composito", "label_b": "label_b"})


ALIGNED_SQL = RISK_SQL + """, runb_q AS (SELECT quantile_cont(score_composito, 0.97) AS hi, quantile_cont(score_composito, 0.9) AS med FROM risk),
aligned AS (SELECT ROTTA, ensemble_score AS score_a, anomaly_label AS label_a, score_composito AS score_b,
  CASE WHEN score_composito >= hi THEN 'HIGH' WHEN score_composito >= med THEN 'MEDIUM' ELSE 'NORMAL' END AS label_b
  FROM risk, runb_q),
ranked AS (SELECT *,
  (2 * rank() OVER (ORDER BY score_a) + count(*) OVER (PARTITION BY score_a) - 1) / 2.0 AS ra,
  (2 * rank() OVER (ORDER BY score_b) + count(*) OVER (PARTITION BY score_b) - 1) / 2.0 AS rb,
  floor((2 * rank() OVER (ORDER BY score_a DESC) + count(*) OVER (PARTITION BY score_a) - 1) / 2.0) AS rank_a,
  floor((2 * rank() OVER (ORDER BY score_b DESC) + count(*) OVER (PARTITION BY score_b) - 1) / 2.0) AS rank_b
  FROM aligned)
"""


@register("run_comparison", ALIGNED_SQL + """SELECT CAST(count(*) AS BIGINT) AS n,
  round(avg(CAST(label_a = label_b AS DOUBLE)), 6) AS agreement, round(corr(score_a, score_b), 6) AS pearson,
  round(corr(ra, rb), 6) AS spearman, CAST(count_if(label_a = 'HIGH' AND label_b = 'HIGH') AS BIGINT) AS both_high,
  CAST(count_if(label_a = 'HIGH' AND label_b <> 'HIGH') AS BIGINT) AS only_a_high,
  CAST(count_if(label_a <> 'HIGH' AND label_b = 'HIGH') AS BIGINT) AS only_b_high FROM ranked""")
def q_run_comparison(spark, sf_dir):
    """E17 + J6 + E7: agreement, Pearson, Spearman (average ranks) and HIGH overlaps of two scorings."""
    return CMP.summary(_aligned(spark, sf_dir), "ROTTA")


@register("label_distribution_pair", ALIGNED_SQL + """SELECT label, CAST(sum(a) AS BIGINT) AS n_a, CAST(sum(b) AS BIGINT) AS n_b FROM (
  SELECT label_a AS label, 1 AS a, 0 AS b FROM aligned UNION ALL SELECT label_b, 0, 1 FROM aligned) GROUP BY label""")
def q_label_distribution_pair(spark, sf_dir):
    """Label distribution of the two runs side by side."""
    return CMP.label_distribution(_aligned(spark, sf_dir))


@register("rank_deltas", ALIGNED_SQL + """SELECT round(avg(abs(rank_a - rank_b)), 6) AS mean_delta,
  round(median(abs(rank_a - rank_b)), 6) AS median_delta, round(max(abs(rank_a - rank_b)), 6) AS max_delta,
  arg_min(ROTTA, (-abs(rank_a - rank_b), ROTTA)) AS max_delta_entity,
  CAST(count_if(abs(rank_a - rank_b) <= 50) AS BIGINT) AS within_50,
  CAST(count_if(abs(rank_a - rank_b) <= 100) AS BIGINT) AS within_100 FROM ranked""")
def q_rank_deltas(spark, sf_dir):
    """W2 + W3: average-rank deltas between the two scorings."""
    return CMP.rank_deltas(_aligned(spark, sf_dir), "ROTTA")


@register("top_overlap", ALIGNED_SQL + """SELECT 10 AS k, CAST(count(*) AS BIGINT) AS overlap FROM
  (SELECT ROTTA FROM aligned ORDER BY score_a DESC, ROTTA LIMIT 10) JOIN (SELECT ROTTA FROM aligned ORDER BY score_b DESC, ROTTA LIMIT 10) USING (ROTTA)
UNION ALL SELECT 50, CAST(count(*) AS BIGINT) FROM
  (SELECT ROTTA FROM aligned ORDER BY score_a DESC, ROTTA LIMIT 50) JOIN (SELECT ROTTA FROM aligned ORDER BY score_b DESC, ROTTA LIMIT 50) USING (ROTTA)""")
def q_top_overlap(spark, sf_dir):
    """Overlap of the top-10 and top-50 sets of the two scorings."""
    return CMP.top_overlap(_aligned(spark, sf_dir), "ROTTA")


@register("divergent_routes", ALIGNED_SQL + """SELECT ROTTA, round(score_a, 6) AS score_a, label_a, round(score_b, 6) AS score_b, label_b,
  label_a = label_b AS label_match, round(score_b - score_a, 6) AS delta_score, round(abs(score_b - score_a), 6) AS abs_delta
FROM aligned WHERE label_a <> label_b ORDER BY abs(score_b - score_a) DESC, ROTTA LIMIT 15""")
def q_divergent_routes(spark, sf_dir):
    """W9 + E18: label mismatches with the largest score differences (top 15)."""
    return CMP.divergent(_aligned(spark, sf_dir), "ROTTA")


@register("global_rank", RISK_SQL + """SELECT ROTTA, round(ensemble_score, 6) AS ensemble_score,
  CAST(row_number() OVER (ORDER BY ensemble_score DESC, ROTTA) AS BIGINT) AS rank FROM risk""")
def q_global_rank(spark, sf_dir):
    """Dense position by score (range-partitioned sort + per-partition offsets)."""
    r = _risk_zonly(spark, sf_dir).select("ROTTA", "ensemble_score")
    return RK.dense_position(r, [F.desc("ensemble_score"), F.asc("ROTTA")])


@register("top_drivers", BASE_SQL + """, u AS (SELECT ROTTA, feature, idx, z FROM baseline
  UNPIVOT (z FOR feature IN (""" + ", ".join(f"z_{c}" for c in FEATS) + """)) p
  JOIN (VALUES """ + ", ".join(f"('z_{c}', {i})" for i, c in enumerate(FEATS)) + """) m(f, idx) ON m.f = p.feature),
r AS (SELECT *, row_number() OVER (PARTITION BY ROTTA ORDER BY abs(z) DESC, idx) AS rn FROM u)
SELECT ROTTA, """ + ", ".join(
    f"max(CASE WHEN rn = {k} THEN substr(feature, 3) END) AS driver_{k}, round(max(CASE WHEN rn = {k} THEN z END), 6) AS z_{k}"
    for k in (1, 2, 3)) + " FROM r WHERE rn <= 3 GROUP BY ROTTA")
def q_top_drivers(spark, sf_dir):
    """Each route's three features with the largest |robust z| (no shuffle)."""
    t = RK.top_abs_per_row(_baseline(spark, sf_dir), FEATS, 3)
    cols = [F.col("ROTTA")]
    for k in (1, 2, 3):
        cols += [F.col("top_drivers")[k - 1]["feature"].alias(f"driver_{k}"),
                 F.col("top_drivers")[k - 1]["z"].alias(f"z_{k}")]
    return t.select(*cols)


# Whole feeds on the supplier grain, where the two route sets differ.
_SUPPLIER_ROUTES = """WITH j AS (SELECT upper(s.s_name) || '-' || upper(nc.n_name) AS ROTTA, l.l_returnflag = 'R' AS alarm
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey),
alarms AS (SELECT ROTTA FROM j WHERE alarm AND ROTTA IS NOT NULL),
travellers AS (SELECT ROTTA FROM j WHERE NOT alarm AND ROTTA IS NOT NULL)
"""


@register("route_coverage", _SUPPLIER_ROUTES + """SELECT CAST(count_if(a.ROTTA IS NOT NULL) AS BIGINT) AS n_a,
  CAST(count_if(t.ROTTA IS NOT NULL) AS BIGINT) AS n_b, CAST(count_if(a.ROTTA IS NOT NULL AND t.ROTTA IS NOT NULL) AS BIGINT) AS n_both,
  CAST(count_if(t.ROTTA IS NULL) AS BIGINT) AS only_a, CAST(count_if(a.ROTTA IS NULL) AS BIGINT) AS only_b,
  CAST(count(*) AS BIGINT) AS n_union
FROM (SELECT DISTINCT ROTTA FROM alarms) a FULL OUTER JOIN (SELECT DISTINCT ROTTA FROM travellers) t ON a.ROTTA = t.ROTTA""")
def q_route_coverage(spark, sf_dir):
    """A18 + U1–U3: route sets of the two whole feeds (supplier grain)."""
    return CMP.coverage(proxy.alarm_feed(spark, sf_dir, "supplier"), proxy.traveller_feed(spark, sf_dir, "supplier"), "ROTTA")


@register("alarm_only_routes", _SUPPLIER_ROUTES + """SELECT ROTTA, CAST(count(*) AS BIGINT) AS n_alarms FROM alarms
WHERE ROTTA NOT IN (SELECT ROTTA FROM travellers) GROUP BY ROTTA""")
def q_alarm_only_routes(spark, sf_dir):
    """Routes with alarms but no traveller records in the whole feeds (anti join, supplier grain)."""
    a = proxy.alarm_feed(spark, sf_dir, "supplier").filter(F.col("ROTTA").isNotNull())
    return CMP.only_in(a, proxy.traveller_feed(spark, sf_dir, "supplier"), "ROTTA") \
        .groupBy("ROTTA").agg(F.count(F.lit(1)).alias("n_alarms"))


# ---------------------------------------------------------------------- studies
from lanewatch.operators import studies as ST  # noqa: E402


def _sens_sql() -> str:
    parts = []
    for i, s in enumerate(ST.sensitivity_scenarios()):
        t = s["t"]
        rules = [f"pct_interpol >= {t['high_interpol_pct']!r}", f"tasso_respinti >= {t['high_rejection_rate']!r}",
                 f"tot_allarmi_log > {t['low_closure_volume']!r} AND tasso_chiusura < {t['low_closure_rate']!r}",
                 f"pct_interpol >= {t['multi_source_pct']!r} AND pct_sdi >= {t['multi_source_pct']!r}",
                 f"tasso_allarme_medio >= {t['high_alarm_rate']!r}"]
        br = "(" + " + ".join(f"CAST(({r}) AS INTEGER)" for r in rules) + ") / 5.0"
        tier = O.tier_sql("coalesce(anomaly_label, 'NORMAL')", br)
        parts.append(f"""SELECT {i} AS scenario_id, {O.q(s['threshold'])} AS threshold, {float(s['baseline_value'])!r} AS baseline_value,
  {float(s['delta_pct'])!r} AS delta_pct, {float(s['perturbed_value'])!r} AS perturbed_value,
  """ + ", ".join(f"CAST(count_if(({tier}) = {O.q(tt)}) AS BIGINT) AS {tt}" for tt in K.RISK_TIERS) + " FROM risk")
    return "sens AS (" + "\nUNION ALL\n".join(parts) + ")"


_SENS_COLS = [("scenario_id", "int"), ("threshold", "str"), ("baseline_value", "double"), ("delta_pct", "double"),
              ("perturbed_value", "double")] + [(t, "bigint") for t in K.RISK_TIERS]


@register("threshold_sensitivity", RISK_SQL + ", " + _sens_sql() + "\n" + O.round_select(_SENS_COLS, "sens"))
def q_threshold_sensitivity(spark, sf_dir):
    """E3 + R13: tier counts with each rule threshold perturbed by -10..+10 % (30 scenarios, one pass)."""
    return ST.threshold_sensitivity(_risk_zonly(spark, sf_dir))


@register("sensitivity_summary", RISK_SQL + ", " + _sens_sql() + """
SELECT threshold, CAST(max(CASE WHEN delta_pct = 0 THEN CRITICAL + HIGH END) AS BIGINT) AS baseline_high_risk,
  CAST(greatest(max(CRITICAL + HIGH) - max(CASE WHEN delta_pct = 0 THEN CRITICAL + HIGH END),
       max(CASE WHEN delta_pct = 0 THEN CRITICAL + HIGH END) - min(CRITICAL + HIGH)) AS BIGINT) AS max_abs_swing,
  round(round(100.0 * greatest(max(CRITICAL + HIGH) - max(CASE WHEN delta_pct = 0 THEN CRITICAL + HIGH END),
       max(CASE WHEN delta_pct = 0 THEN CRITICAL + HIGH END) - min(CRITICAL + HIGH))
       / greatest(max(CASE WHEN delta_pct = 0 THEN CRITICAL + HIGH END), 1), 1), 6) AS swing_pct_of_baseline
FROM sens GROUP BY threshold""")
def q_sensitivity_summary(spark, sf_dir):
    """Largest swing of CRITICAL + HIGH per threshold."""
    return ST.sensitivity_summary(ST.threshold_sensitivity(_risk_zonly(spark, sf_dir)))


_MATRIX = dict(zip(["minus_10", "minus_5", "base", "plus_5", "plus_10"], K.SENSITIVITY_DELTAS))


@register("sensitivity_matrix", RISK_SQL + ", " + _sens_sql() + "\nSELECT threshold, " + ", ".join(
    f"CAST(max(CASE WHEN delta_pct = {float(d)!r} THEN HIGH END) AS BIGINT) AS {c}" for c, d in _MATRIX.items()) + " FROM sens GROUP BY threshold")
def q_sensitivity_matrix(spark, sf_dir):
    """HIGH-tier counts as a threshold x delta matrix."""
    return ST.sensitivity_matrix(ST.threshold_sensitivity(_risk_zonly(spark, sf_dir))).toDF("threshold", *_MATRIX)


@register("label_threshold_grid", RISK_SQL + """, qq AS (SELECT round(quantile_cont(ensemble_score, 0.97), 3) AS hi,
  round(quantile_cont(ensemble_score, 0.9), 3) AS med FROM risk),
hs AS (SELECT unnest([0.3, 0.35, 0.4, 0.45, 0.5]) AS high_t UNION ALL SELECT hi FROM qq),
ms AS (SELECT unnest([0.15, 0.2, 0.25]) AS medium_t UNION ALL SELECT med FROM qq),
pairs AS (SELECT DISTINCT CAST(high_t AS DOUBLE) AS high_t, CAST(medium_t AS DOUBLE) AS medium_t FROM hs, ms WHERE medium_t < high_t)
SELECT round(high_t, 6) AS high_t, round(medium_t, 6) AS medium_t, CAST(count_if(ensemble_score >= high_t) AS BIGINT) AS n_high,
  CAST(count_if(ensemble_score >= medium_t AND ensemble_score < high_t) AS BIGINT) AS n_medium,
  CAST(count_if(ensemble_score < medium_t) AS BIGINT) AS n_normal,
  round(round(100.0 * (count_if(ensemble_score >= high_t) + count_if(ensemble_score >= medium_t AND ensemble_score < high_t)) / count(*), 1), 6) AS alert_pct
FROM pairs, risk GROUP BY high_t, medium_t""")
def q_label_threshold_grid(spark, sf_dir):
    """E5: label counts and alert share over a HIGH x MEDIUM cut-off grid."""
    return ST.label_threshold_grid(_risk_zonly(spark, sf_dir))


_BOOT_ITERS = 1000


def _boot_sql() -> str:
    per = f"""bx AS (SELECT a.*, it.it, row_number() OVER (PARTITION BY it.it ORDER BY
    md5(ROTTA || '|' || CAST(it.it AS VARCHAR) || '|42'), ROTTA) AS rn FROM aligned a, range({_BOOT_ITERS}) it(it)),
bs AS (SELECT * FROM bx WHERE rn <= (SELECT greatest(2, CAST(floor(count(*) * 0.8) AS BIGINT)) FROM aligned)),
br AS (SELECT *, (2 * rank() OVER (PARTITION BY it ORDER BY score_a) + count(*) OVER (PARTITION BY it, score_a) - 1) / 2.0 AS ra2,
  (2 * rank() OVER (PARTITION BY it ORDER BY score_b) + count(*) OVER (PARTITION BY it, score_b) - 1) / 2.0 AS rb2 FROM bs),
per AS (SELECT it, avg(CAST(label_a = label_b AS DOUBLE)) AS agreement, corr(score_a, score_b) AS pearson,
  corr(ra2, rb2) AS spearman FROM br GROUP BY it),
pt AS (SELECT avg(CAST(label_a = label_b AS DOUBLE)) AS agreement, corr(score_a, score_b) AS pearson, corr(ra, rb) AS spearman FROM ranked)"""
    rows = []
    for m in ("agreement", "pearson", "spearman"):
        rows.append(f"""SELECT {O.q(m)} AS metric, round((SELECT {m} FROM pt), 6) AS point, round(avg({m}), 6) AS mean,
  round(stddev_samp({m}), 6) AS std, round(quantile_cont({m}, 0.025), 6) AS lo_95, round(quantile_cont({m}, 0.975), 6) AS hi_95,
  round(quantile_cont({m}, 0.975) - quantile_cont({m}, 0.025), 6) AS ci_width, {_BOOT_ITERS} AS n_iter, 0.8 AS sample_frac FROM per""")
    return ALIGNED_SQL + ", " + per + "\n" + "\nUNION ALL\n".join(rows)


@register("bootstrap_ci", _boot_sql())
def q_bootstrap_ci(spark, sf_dir):
    """E6 + E7: 1000 x 80 % subsample CIs of label agreement, Pearson and Spearman between two scorings."""
    return ST.bootstrap_ci(_aligned(spark, sf_dir), n_iter=_BOOT_ITERS)


@register("topk_stability", RISK_SQL + """, top AS (SELECT ROTTA FROM risk ORDER BY ensemble_score DESC, ROTTA LIMIT 17),
sh AS (SELECT ROTTA, avg(CAST(CAST(('0x' || substr(md5(ROTTA || '|' || CAST(b AS VARCHAR) || '|42'), 1, 8)) AS BIGINT) / 4294967296.0 < 0.8 AS DOUBLE)) AS share
  FROM top, range(200) t(b) GROUP BY ROTTA)
SELECT round(avg(share), 6) AS stability, 17 AS k, 200 AS n_boot FROM sh""")
def q_topk_stability(spark, sf_dir):
    """Top-17 set stability under 80 % resampling (200 draws)."""
    return ST.topk_stability(_risk_zonly(spark, sf_dir))


@register("silhouette", RISK_SQL + ", " + O.scaled_cte("risk", "sc") + """,
lab AS (SELECT sc.*, CASE WHEN r.anomaly_label <> 'NORMAL' THEN '1' ELSE '0' END AS lab FROM sc JOIN risk r USING (ROTTA)),
pd AS (SELECT a.ROTTA, a.lab AS la, b.lab AS lb, sqrt(""" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATS) + """) AS d
  FROM lab a JOIN lab b ON a.ROTTA <> b.ROTTA),
pp AS (SELECT ROTTA, avg(CASE WHEN la = lb THEN d END) AS a, avg(CASE WHEN la <> lb THEN d END) AS b,
  count_if(la = lb) AS na FROM pd GROUP BY ROTTA)
SELECT round(avg(CASE WHEN na = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, CAST(count(*) AS BIGINT) AS n FROM pp""")
def q_silhouette(spark, sf_dir):
    """Exact silhouette of the anomalous / normal split on the scaled features."""
    r = _risk_zonly(spark, sf_dir)
    pts = standard_scale(r.select("ROTTA", *FEATS), FEATS).join(
        r.select("ROTTA", F.when(F.col("anomaly_label") != "NORMAL", "1").otherwise("0").alias("lab")), on="ROTTA")
    return ST.silhouette(pts, FEATS, "lab")


_LAB_SQL = RISK_SQL + ", " + O.scaled_cte("risk", "sc") + """,
lab AS (SELECT sc.*, CASE WHEN r.anomaly_label <> 'NORMAL' THEN '1' ELSE '0' END AS lab FROM sc JOIN risk r USING (ROTTA))
"""
_CENTRED = " + ".join(f"(l.{c} - m.{c}) * (l.{c} - m.{c})" for c in FEATS)


@register("cluster_indices", _LAB_SQL + f""", cen AS (SELECT lab, count(*) AS n, {', '.join(f'avg({c}) AS {c}' for c in FEATS)} FROM lab GROUP BY lab),
alls AS (SELECT {', '.join(f'avg({c}) AS {c}' for c in FEATS)} FROM lab),
disp AS (SELECT l.lab, avg(sqrt({_CENTRED})) AS s, sum({_CENTRED}) AS w FROM lab l JOIN cen m USING (lab) GROUP BY l.lab),
gap AS (SELECT sqrt({_CENTRED}) AS d FROM cen l, cen m WHERE l.lab = '0' AND m.lab = '1'),
bss AS (SELECT sum(l.n * ({_CENTRED})) AS b FROM cen l, alls m)
SELECT round((SELECT sum(s) FROM disp) / (SELECT d FROM gap), 6) AS davies_bouldin,
  round((SELECT b FROM bss) / ((SELECT sum(w) FROM disp) / (count(*) - 2)), 6) AS calinski_harabasz, 2 AS k FROM lab""")
def q_cluster_indices(spark, sf_dir):
    """Davies–Bouldin and Calinski–Harabasz of the anomalous / normal split."""
    r = _risk_zonly(spark, sf_dir)
    pts = standard_scale(r.select("ROTTA", *FEATS), FEATS).join(
        r.select("ROTTA", F.when(F.col("anomaly_label") != "NORMAL", "1").otherwise("0").alias("lab")), on="ROTTA")
    return ST.cluster_indices(pts, FEATS, "lab")


def _full_scored(spark, sf_dir):
    res = _full(spark, sf_dir)
    return res.risk


@register("ablation_study")
def q_ablation_study(spark, sf_dir):
    """Detector-subset ablation of the four-detector ensemble."""
    return ST.ablation(_full_scored(spark, sf_dir))


@memo(persist=True)
def _grid(spark, sf_dir):
    return ST.weight_grid(_full_scored(spark, sf_dir))


@register("weight_grid")
def q_weight_grid(spark, sf_dir):
    """969-vector weight grid (step 0.05, all > 0), objective and rank."""
    return _grid(spark, sf_dir)


@register("weight_grid_summary")
def q_weight_grid_summary(spark, sf_dir):
    """Best grid vector versus the production weights."""
    return ST.grid_summary(_grid(spark, sf_dir)).select(
        "n_weight_vectors", "best_objective", "production_objective", "production_rank", "worst_objective",
        "best_minus_production", F.to_json("best_weights").alias("best_weights"))


@register("weight_grid_marginal")
def q_weight_grid_marginal(spark, sf_dir):
    """Best objective for each (w_if, w_z) pair."""
    return ST.marginal_max(_grid(spark, sf_dir))


@register("full_topk_stability")
def q_full_topk_stability(spark, sf_dir):
    """E8 on the four-detector ensemble."""
    return ST.topk_stability(_full_scored(spark, sf_dir))


@memo(persist=True)
def _refit(spark, sf_dir):
    sc = _scaled(spark, sf_dir)
    return ST.refit_stability(sc, FEATS, _full_scored(spark, sf_dir), n_iter=100)


@register("refit_stability")
def q_refit_stability(spark, sf_dir):
    """Share of 100 forest refits (80 % subsamples) flagging each route; stable >= 0.70."""
    return _refit(spark, sf_dir)


@register("stability_consistency")
def q_stability_consistency(spark, sf_dir):
    """Refit-stable routes versus ML anomalies."""
    return ST.stability_consistency(_refit(spark, sf_dir))


@memo(persist=False)
def _forest(spark, sf_dir):
    sc = _scaled(spark, sf_dir)
    return keep(IFm.fit(sc, FEATS, n_trees=K.N_TREES, max_samples=K.MAX_SAMPLES, seed=K.RANDOM_STATE))


_PERMUTED = IF_SQL + f""", placed AS (SELECT *, row_number() OVER (ORDER BY ROTTA) - 1 AS i, count(*) OVER () AS n FROM scaled),
sides AS (SELECT *, greatest(1, CAST(ceil(n / CAST(a AS DOUBLE)) AS BIGINT)) AS b FROM (SELECT *, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM placed)),
moved AS (SELECT *, {O.shuffled_sql('i', 'n', "'42', CAST(sid AS VARCHAR)")} AS j FROM sides, range({len(FEATS)}) t(sid)),
permuted AS (SELECT CAST(m.sid AS VARCHAR) || '#' || m.ROTTA AS ROTTA,
  {', '.join(f'CASE WHEN m.sid = {k} THEN d.{c} ELSE m.{c} END AS {c}' for k, c in enumerate(FEATS))} FROM moved m JOIN placed d ON d.i = m.j),
{O.iforest_cte("scaled", "again", score_src="permuted")}
"""


@register("permutation_importance", _PERMUTED + f"""SELECT ([{', '.join(O.q(c) for c in FEATS)}])[1 + CAST(string_split(ROTTA, '#')[1] AS INTEGER)] AS feature,
  round(avg(if_score) - (SELECT avg(if_score) FROM forest), 6) AS importance FROM again GROUP BY 1""")
def q_permutation_importance(spark, sf_dir):
    """Isolation-score shift after shuffling each feature."""
    return ST.permutation_importance(_scaled(spark, sf_dir), _forest(spark, sf_dir), FEATS)


@register("topset_turnover")
def q_topset_turnover(spark, sf_dir):
    """Top-10 % set turnover over 30 permutations per feature."""
    return ST.topset_turnover(_scaled(spark, sf_dir), _forest(spark, sf_dir), FEATS, n_perms=30)


@memo(persist=False)
def _surrogate(spark, sf_dir):
    r = _full_scored(spark, sf_dir)
    pts = standard_scale(r.select("ROTTA", *FEATS), FEATS).join(
        r.select("ROTTA", (F.col("anomaly_label") != "NORMAL").cast("int").alias("is_anomaly")), on="ROTTA")
    pts = keep(pts)
    model, imps, acc = ST.surrogate(pts, FEATS)
    return pts, model, imps, acc


@register("surrogate_importance")
def q_surrogate_importance(spark, sf_dir):
    """Gradient-boosted surrogate of the ML labels: feature importances and accuracy."""
    pts, model, imps, acc = _surrogate(spark, sf_dir)
    a = acc.first()["accuracy"]
    return imps.withColumn("surrogate_accuracy", F.lit(a))


@register("attribution_global")
def q_attribution_global(spark, sf_dir):
    """Mean |p(x) - p(x with feature = 0)| of the surrogate per feature."""
    pts, model, _, _ = _surrogate(spark, sf_dir)
    return ST.global_attribution(ST.zeroing_attribution(pts, model, FEATS))


@register("attribution_top3")
def q_attribution_top3(spark, sf_dir):
    """Each route's three largest attributions."""
    pts, model, _, _ = _surrogate(spark, sf_dir)
    return ST.top_attributions(ST.zeroing_attribution(pts, model, FEATS))


@register("attribution_shapley")
def q_attribution_shapley(spark, sf_dir):
    """Sampled Shapley values of the surrogate per route and feature, with their standard errors."""
    pts, model, _, _ = _surrogate(spark, sf_dir)
    return ST.shapley_attribution(pts, model, FEATS)


# ------------------------------------------------------------------ explanations
from lanewatch.operators import explain as EX  # noqa: E402
from lanewatch.sources.tables import table  # noqa: E402

_ZL = list(EX.Z_LABELS.items())


def _drivers_sql(k: int) -> str:
    """rows (ROTTA, rn, label, v, z) of the top-k narration drivers from `risk`."""
    un = "\nUNION ALL\n".join(
        f"SELECT ROTTA, {i} AS idx, {O.q(lbl)} AS label, CAST({v} AS DOUBLE) AS v, CAST({z} AS DOUBLE) AS z FROM risk"
        for i, (z, (v, lbl)) in enumerate(_ZL))
    return f"""drv_all AS ({un}),
drv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ROTTA ORDER BY -abs(z), idx) AS rn
  FROM drv_all WHERE z IS NOT NULL) WHERE rn <= {k})"""


def _fmt_sql(x: str, d: int = 3) -> str:
    return f"coalesce(printf('%.{d}f', round(CAST({x} AS DOUBLE), {d})), 'N/D')"


_RULES_TXT = ("coalesce(nullif(concat_ws('; ', " + ", ".join(
    f"CASE WHEN {n} = 1 THEN {O.q(K.RULE_LABELS[n])} END" for n in K.RULE_LABELS) + "), ''), '{none}')")


@register("narration_template", RISK_SQL + ", " + _drivers_sql(2) + f""",
d2 AS (SELECT ROTTA, string_agg(label || '=' || {_fmt_sql('v')} || ' (' || printf('%+.2f', round(z, 2)) || 'σ)', ', ' ORDER BY rn) AS d
  FROM drv GROUP BY ROTTA)
SELECT r.ROTTA, 'Route ' || r.ROTTA || ' classified ' || coalesce(r.final_risk, r.anomaly_label, 'N/A') || '. Main drivers: '
  || coalesce(d2.d, 'n/a') || '. Business rules: ' || {_RULES_TXT.replace('{none}', 'no business rule fired')} || '.' AS explanation
FROM risk r LEFT JOIN d2 ON r.ROTTA = d2.ROTTA""")
def q_narration_template(spark, sf_dir):
    """Deterministic two-driver explanation per route."""
    return EX.template_text(_risk_zonly(spark, sf_dir))


@register("narration_context", RISK_SQL + ", " + _drivers_sql(3) + f""",
d3 AS (SELECT ROTTA, string_agg('  - ' || label || ': valore=' || {_fmt_sql('v')} || ', deviazione=' || printf('%+.2f', round(z, 2))
  || 'σ dalla baseline', chr(10) ORDER BY rn) AS d FROM drv GROUP BY ROTTA)
SELECT r.ROTTA, 'ROUTE: ' || r.ROTTA || ' | Departure country: ' || coalesce(r.PAESE_PART, 'N/A') || ' | Zone: '
  || coalesce(CAST(r.ZONA AS VARCHAR), 'N/A') || chr(10) || 'Anomaly level: ' || coalesce(r.anomaly_label, 'N/A')
  || ' | Final risk classification: ' || coalesce(r.final_risk, 'N/A') || ' | Ensemble score: ' || {_fmt_sql('coalesce(r.ensemble_score, 0)')}
  || chr(10) || 'Score per model: IsolationForest=0.000, LOF=0.000, Autoencoder=0.000' || chr(10) || 'Volumes: total_alarms='
  || {_fmt_sql('r.tot_allarmi_sum')} || ', passengers_entered=' || {_fmt_sql('r.tot_entrati')} || chr(10) || 'Business rules fired: '
  || {_RULES_TXT.replace('{none}', 'none fired')} || chr(10) || 'Top 3 anomaly drivers (features furthest from historical baseline):'
  || chr(10) || coalesce(d3.d, '  - z-score non disponibili per questa rotta') AS context
FROM risk r LEFT JOIN d3 ON r.ROTTA = d3.ROTTA""")
def q_narration_context(spark, sf_dir):
    """Narration context per route (drivers, scores per model, rules, volumes) — Z run."""
    return EX.context_text(_risk_zonly(spark, sf_dir))


_SORTED_RULES = ("coalesce(array_to_string(list_sort(list_filter([" + ", ".join(
    f"CASE WHEN {n} = 1 THEN {O.q(K.RULE_LABELS[n])} END" for n in K.RULE_LABELS) + "], lambda x: x IS NOT NULL)), '|'), '')")


@register("narration_signature", RISK_SQL + ", " + _drivers_sql(3) + f""",
d3 AS (SELECT ROTTA, list(label || '|' || CAST(round(v, 3) AS VARCHAR) || '|' || CAST(round(z, 2) AS VARCHAR) ORDER BY rn) AS d
  FROM drv GROUP BY ROTTA),
sig AS (SELECT r.ROTTA, array_to_string(list_concat(list_concat([r.ROTTA, r.anomaly_label, r.final_risk], coalesce(d3.d, [])),
  [{_SORTED_RULES}]), chr(10)) AS signature_text FROM risk r LEFT JOIN d3 ON r.ROTTA = d3.ROTTA)
SELECT ROTTA, signature_text, sha256(signature_text) AS signature FROM sig""")
def q_narration_signature(spark, sf_dir):
    """Stable narration cache signature (no model scores) and its SHA-256."""
    return EX.signature(_risk_zonly(spark, sf_dir))


_PATTERN_SQL = (f"""pat AS (SELECT ROTTA, final_risk, confidence, coalesce(nullif(confidence, 0), ensemble_score, 0) AS weight,
  upper(coalesce(final_risk, anomaly_label, '')) IN ('CRITICAL', 'HIGH') AS narrated,
  concat_ws(' || ', array_to_string(list_sort(list_filter([""" + ", ".join(
    f"CASE WHEN {n} = 1 THEN {O.q(K.RULE_LABELS[n])} END" for n in K.RULE_LABELS) + """], lambda x: x IS NOT NULL)), ' | '),
    coalesce(final_risk, '')) AS pattern
  FROM risk),
pr AS (SELECT *, narrated AND row_number() OVER (PARTITION BY pattern, narrated ORDER BY weight DESC, ROTTA) = 1 AS is_representative,
  count_if(narrated) OVER () AS n_narrated FROM pat),
plan AS (SELECT *, CASE WHEN NOT narrated THEN 'template'
  WHEN n_narrated > 15 AND NOT is_representative THEN 'dedup_template' ELSE 'llm' END AS source FROM pr)""")


@register("risk_patterns", RISK_SQL + ", " + _PATTERN_SQL + """
SELECT ROTTA, final_risk, round(confidence, 6) AS confidence, pattern, narrated, is_representative, source FROM plan""")
def q_risk_patterns(spark, sf_dir):
    """T4 + T5 + W7: risk-pattern fingerprints, representatives and the source of each narration."""
    return EX.narration_plan(_risk_zonly(spark, sf_dir))


@register("narration_sources", RISK_SQL + ", " + _PATTERN_SQL + """
SELECT source, CAST(count(*) AS BIGINT) AS n FROM plan GROUP BY source""")
def q_narration_sources(spark, sf_dir):
    """T5 + A36: narration gating by tier and pattern; counts per narration source."""
    return EX.source_counts(EX.narration_plan(_risk_zonly(spark, sf_dir)))


@register("narration_summary", RISK_SQL + ", " + _PATTERN_SQL + """
SELECT CASE WHEN count_if(narrated) > 15 THEN 'pattern-dedup' ELSE 'per-route' END AS mode,
  CAST(CASE WHEN count_if(narrated) > 15 THEN count(DISTINCT CASE WHEN narrated THEN pattern END) ELSE 0 END AS BIGINT) AS patterns,
  CAST(count_if(source = 'llm') AS BIGINT) AS n_llm, CAST(count_if(source = 'template') AS BIGINT) AS n_template,
  CAST(count_if(source = 'dedup_template') AS BIGINT) AS n_dedup_template FROM plan""")
def q_narration_summary(spark, sf_dir):
    """Narration block of the report: mode, patterns, texts per source."""
    return EX.narration_summary(EX.narration_plan(_risk_zonly(spark, sf_dir)))


def _pairs(spark, sf_dir):
    return EX.conversation_pairs(table(spark, sf_dir, "conversations"))


_PAIRS_SQL = """WITH pairs AS (SELECT u.conv_id, u.turn, u.text AS context, a.text AS text FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn - 1 = u.turn AND a.role = 'assistant' WHERE u.role = 'user'),
q AS (SELECT *, list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '-?\\d+\\.?\\d*'), lambda x: round(TRY_CAST(x AS DOUBLE), 2)), lambda x: x IS NOT NULL) AS out_n,
  list_distinct(list_filter(list_transform(regexp_extract_all(coalesce(context, ''), '-?\\d+\\.?\\d*'), lambda x: round(TRY_CAST(x AS DOUBLE), 2)), lambda x: x IS NOT NULL)) AS ctx_n
  FROM pairs),
q2 AS (SELECT *, list_filter(out_n, lambda n: NOT coalesce(list_bool_or(list_transform(ctx_n, lambda c: abs(n - c) <= 0.01 OR abs(n / 100 - c) <= 0.01 OR abs(n * 100 - c) <= 0.01)), false)) AS un FROM q),
tq AS (SELECT conv_id, turn, context, text, CAST(len(out_n) AS INTEGER) AS numbers_cited, CAST(len(un) AS INTEGER) AS hallucinated_count,
  CASE WHEN len(out_n) > 0 THEN round_even(1 - len(un) / len(out_n), 3) ELSE 1.0 END AS faithfulness,
  CAST(len(list_filter(string_split_regex(trim(coalesce(text, '')), '[.!?]+\\s+'), lambda s: length(trim(s)) > 0)) AS INTEGER) AS sentences,
  CAST(length(coalesce(text, '')) AS INTEGER) AS chars, length(trim(coalesce(text, ''))) = 0 AS empty,
  array_to_string(list_transform(un, lambda u: printf('%.2f', u)), ',') AS unmatched,
  array_to_string(list_filter([""" + ", ".join(O.q(w) for w in EX.MARKER_WORDS) + """], lambda w: instr(lower(coalesce(text, '')), w) > 0), ',') AS marker_leak
  FROM q2)
"""


@register("text_quality", _PAIRS_SQL + """SELECT conv_id, turn, numbers_cited, hallucinated_count, round(faithfulness, 6) AS faithfulness,
  sentences, chars, empty, marker_leak, unmatched FROM tq""")
def q_text_quality(spark, sf_dir):
    """T6 + T7 + T9: numbers cited, faithfulness to the context, sentences, chars, marker leaks
    for every (user context, assistant reply) pair of the conversations table."""
    t = EX.text_quality(_pairs(spark, sf_dir))
    return t.select("conv_id", "turn", "numbers_cited", "hallucinated_count", "faithfulness", "sentences", "chars",
                    "empty", "marker_leak", "unmatched")


@register("text_guardrail", _PAIRS_SQL + """, pieces AS (SELECT conv_id, turn, ctx_n, regexp_split_to_array(coalesce(text, ''), '-?\\d+\\.?\\d*') AS ps,
  regexp_extract_all(coalesce(text, ''), '-?\\d+\\.?\\d*') AS ts FROM q),
toks AS (SELECT conv_id, turn, ctx_n, ps, i, ts[i] AS tok, round(TRY_CAST(ts[i] AS DOUBLE), 2) AS v
  FROM pieces, unnest(range(1, len(ps) + 1)) AS t(i)),
judged AS (SELECT *, coalesce(v IS NOT NULL AND len(ctx_n) > 0 AND (contains(tok, '.') OR abs(v) >= 100)
    AND NOT list_bool_or(list_transform(ctx_n, lambda c: abs(v - c) <= 0.01 OR abs(v / 100 - c) <= 0.01 OR abs(v * 100 - c) <= 0.01)), false) AS fixed,
  list_min(list_transform(ctx_n, lambda c: {'d': abs(c - v), 'a': c})).a AS near FROM toks)
SELECT conv_id, turn, CAST(count_if(fixed) AS INTEGER) AS guardrail_fixes,
  string_agg(ps[i] || coalesce(CASE WHEN fixed THEN CASE WHEN near = floor(near) THEN CAST(CAST(near AS BIGINT) AS VARCHAR)
    ELSE printf('%.2f', near) END ELSE tok END, ''), '' ORDER BY i) AS guarded_text FROM judged GROUP BY conv_id, turn""")
def q_text_guardrail(spark, sf_dir):
    """Guardrail rewrite of unsupported figures and its fix count."""
    g = EX.guardrail(_pairs(spark, sf_dir))
    return g.select("conv_id", "turn", "guardrail_fixes", "guarded_text")


NARRATION_MODEL = "claude-sonnet-4-5"


@register("narration_cost", _PAIRS_SQL + f""", tc AS (SELECT *,
  greatest(1, CAST(floor(length(coalesce(context, '')) / 4) AS INTEGER)) AS in_tokens,
  greatest(1, CAST(floor(length(coalesce(text, '')) / 4) AS INTEGER)) AS out_tokens FROM tq),
tc2 AS (SELECT *, CAST(in_tokens AS BIGINT) * 3000 + CAST(out_tokens AS BIGINT) * 15000 AS nano FROM tc)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_samples, round(round(avg(out_tokens), 1), 6) AS avg_out_tokens,
  round(quantile_cont(out_tokens, 0.5), 6) AS p50_out_tokens, round(quantile_cont(out_tokens, 0.95), 6) AS p95_out_tokens,
  min(out_tokens) AS min_out_tokens, max(out_tokens) AS max_out_tokens, round(round(avg(in_tokens), 1), 6) AS avg_in_tokens,
  round(round(avg(faithfulness), 3), 6) AS avg_faithfulness, CAST(sum(hallucinated_count) AS BIGINT) AS total_hallucinated,
  CAST(count_if(empty) AS BIGINT) AS empty_outputs, round(round(avg(sentences), 1), 6) AS avg_sentences,
  """ + ", ".join(f"CAST((2 * {k} * sum(nano) + 1000 * count(*)) // (2000 * count(*)) AS BIGINT) / CAST(1000000.0 AS DOUBLE) AS {name}"
                  for k, name in ((1, "cost_per_item"), (17, "run_17_usd"), (57, "run_57_usd"))) + """ FROM tc2 GROUP BY conv_id""")
def q_narration_cost(spark, sf_dir):
    """T10 + J11 + A35: token estimate (chars / 4), price by model-id match, quality and cost per conversation."""
    t = EX.token_cost(EX.text_quality(_pairs(spark, sf_dir)), F.lit(NARRATION_MODEL))
    return EX.quality_by_group(t, "conv_id")


@register("narration_cache_split")
def q_narration_cache_split(spark, sf_dir):
    """Narration signatures of the full run found (hit) or not (miss) in the cache built
    by the January-1997 perimeter run."""
    cur = EX.signature(_risk_zonly(spark, sf_dir))
    f = _perimeter_features(spark, sf_dir, PERIMETER_JAN97)
    scored, _ = score_entities(B.robust_zscores(f), detectors=("Z",))
    cache = EX.signature(R.apply_rules(scored))
    hits, misses = EX.cache_split(cur, cache)
    return hits.select("ROTTA", F.lit("hit").alias("status")).unionByName(misses.select("ROTTA", F.lit("miss").alias("status")))


@register("report_findings")
def q_report_findings(spark, sf_dir):
    """One JSON finding per alert route with the report scope."""
    return EX.report_findings(_risk_zonly(spark, sf_dir), scope="all years, all routes")


# ------------------------------------------------------------ sources / sinks
from lanewatch.sources import files as FS  # noqa: E402
from pyspark.sql.types import ArrayType, StringType, StructField, StructType  # noqa: E402

_RAW_A_COLS = ["_rid"] + OC.ALARM_RAW_COLS


@register("csv_roundtrip", O.with_(O.alarms_cte(), O.travellers_cte(), OC.raw_alarms_cte())
          + "SELECT CAST(_rid AS VARCHAR) AS _rid, " + ", ".join(OC.ALARM_RAW_COLS) + " FROM raw_alarms")
def q_csv_roundtrip(spark, sf_dir):
    """S1 + S4 + S5: dirty alarm records written as ';'-separated CSV to shared storage and
    read back as all strings with the separator sniffed from the header."""
    path = FS.scratch_path(spark, "raw-alarms-csv")
    raw = proxy.raw_alarm_feed(spark, sf_dir).select(*_RAW_A_COLS)
    FS.write_csv(raw, path, sep=";")
    return FS.load_csv(spark, path)


@register("typed_csv_roundtrip", FEEDS_SQL + """SELECT CAST(_rid AS VARCHAR) AS rid, ROTTA, strftime(DATA_PARTENZA, '%Y-%m-%d %H:%M') AS departed,
  round(CAST(TOT AS DOUBLE), 6) AS tot, concat_ws(' | ', MOTIVO_ALLARME, CAST(ZONA AS VARCHAR)) AS tags FROM alarms""")
def q_typed_csv_roundtrip(spark, sf_dir):
    """S2 + S3 + S5: alarm records with a list column written as CSV, read back with explicit types and a date format."""
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType
    path = FS.scratch_path(spark, "typed-csv")
    a = _alarms(spark, sf_dir)
    FS.write_csv(a.select(F.col("_rid").cast("string").alias("rid"), "ROTTA",
                          F.date_format("DATA_PARTENZA", "dd/MM/yyyy HH:mm").alias("departed"), F.col("TOT").cast("double").alias("tot"),
                          F.array_compact(F.array("MOTIVO_ALLARME", F.col("ZONA").cast("string"))).alias("tags")), path)
    schema = StructType([StructField("rid", StringType()), StructField("ROTTA", StringType()), StructField("departed", TimestampType()),
                         StructField("tot", DoubleType()), StructField("tags", StringType())])
    back = FS.load_typed(spark, path, schema, "csv", "dd/MM/yyyy HH:mm")
    return back.withColumn("departed", F.date_format("departed", "yyyy-MM-dd HH:mm"))


@register("json_roundtrip", RISK_SQL + """SELECT ROTTA, final_risk, round(confidence, 6) AS confidence,
  array_to_string(list_filter([""" + ", ".join(f"CASE WHEN {n} = 1 THEN {O.q(K.RULE_LABELS[n])} END" for n in K.RULE_LABELS)
          + """], lambda x: x IS NOT NULL), ' | ') AS risk_drivers FROM risk""")
def q_json_roundtrip(spark, sf_dir):
    """S6 + S7: risk rows as JSON records, written as JSON lines and parsed back with a schema."""
    from pyspark.sql.types import DoubleType
    r = _risk_zonly(spark, sf_dir).select("ROTTA", "final_risk", "confidence", "risk_drivers")
    path = FS.scratch_path(spark, "risk-json")
    FS.write_json(r, path)
    schema = StructType([StructField("ROTTA", StringType()), StructField("final_risk", StringType()),
                         StructField("confidence", DoubleType()), StructField("risk_drivers", ArrayType(StringType()))])
    back = FS.from_records(spark.read.text(path).withColumnRenamed("value", "record"), schema)
    return back.withColumn("risk_drivers", F.array_join("risk_drivers", " | "))


@register("strict_second_pass")
def q_strict_second_pass(spark, sf_dir):
    """D12 + D13: stricter forest on all routes; robust HIGH, downgrades, re-run flag."""
    sup = EN.strict_second_pass(_full(spark, sf_dir).scored, _scaled(spark, sf_dir), FEATS)
    return EN.supervision_summary(sup)


@register("perimeter_sweep")
def q_perimeter_sweep(spark, sf_dir):
    """Tier counts of the pipeline recomputed inside four perimeters."""
    from lanewatch.plans.pipeline import perimeter_sweep
    perims = [{"anno": 1997}, {"anno": 1997, "paese_partenza": "NATION_1"},
              {"anno": 1997, "aeroporto_arrivo": "NATION_2"}, {"anno": 1997, "zona": 1}]
    return perimeter_sweep(proxy.alarm_feed(spark, sf_dir), proxy.traveller_feed(spark, sf_dir), perims)


# -------------------------------------------------------------------- streaming
from lanewatch.streaming import drift as DR  # noqa: E402
from lanewatch.streaming import windows as SW  # noqa: E402

_WIN_SQL = O.with_(O.features_cte()) + """, sa AS (
  SELECT CAST(l.l_shipdate AS TIMESTAMP) AS ts, upper(ns.n_name) || '-' || upper(nc.n_name) AS ROTTA, l.l_quantity AS TOT,
    """ + O.case_map("o.o_orderpriority", __import__("lanewatch.sources.proxy", fromlist=["x"]).MOTIVE_OF_PRIORITY) + """ AS MOTIVO_ALLARME
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation ns ON s.s_nationkey = ns.n_nationkey
  JOIN nation nc ON c.c_nationkey = nc.n_nationkey WHERE l.l_returnflag = 'R'),
wa AS (SELECT time_bucket(INTERVAL '30 days', ts, TIMESTAMP '1970-01-01') AS window_start, ROTTA,
  count(*) AS n_alarms, sum(TOT) AS tot, count_if(MOTIVO_ALLARME = 'INTERPOL') AS n_interpol,
  count_if(MOTIVO_ALLARME = 'SDI') AS n_sdi, count(MOTIVO_ALLARME) AS n_motives FROM sa GROUP BY ALL),
we AS (SELECT *, window_start + INTERVAL '30 days' AS window_end FROM wa),
ws AS (SELECT we.*, CASE WHEN n_motives > 0 THEN n_interpol / n_motives ELSE 0.0 END AS pct_interpol_window,
  CASE WHEN n_motives > 0 THEN n_sdi / n_motives ELSE 0.0 END AS pct_sdi_window, f.pct_interpol AS pct_interpol_baseline
  FROM we LEFT JOIN features f ON f.ROTTA = we.ROTTA)
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end,
  ROTTA, CAST(n_alarms AS BIGINT) AS n_alarms, round(tot, 6) AS tot, round(pct_interpol_window, 6) AS pct_interpol_window,
  round(pct_sdi_window, 6) AS pct_sdi_window, round(pct_interpol_baseline, 6) AS pct_interpol_baseline,
  CAST(pct_interpol_window >= 0.3 AS INTEGER) AS br_high_interpol,
  CAST(pct_interpol_window >= 0.1 AND pct_sdi_window >= 0.1 AS INTEGER) AS br_multi_source,
  round(pct_interpol_window - coalesce(pct_interpol_baseline, 0.0), 6) AS interpol_drift FROM ws"""


@register("stream_window_alerts", _WIN_SQL)
def q_stream_window_alerts(spark, sf_dir):
    """Streamed alarm records -> 30-day tumbling windows per route (update mode,
    stream-static joins, nothing dropped as late) -> window rules against the frozen feature table."""
    w = SW.run_window_job(spark, sf_dir)
    return SW.score_windows(w, _features(spark, sf_dir))


@register("monthly_drift", FEEDS_SQL + """, g AS (SELECT ROTTA, strftime(DATA_PARTENZA, '%Y-%m') AS month, count(*) AS n_alarms,
  CASE WHEN count(MOTIVO_ALLARME) > 0 THEN count_if(MOTIVO_ALLARME = 'INTERPOL') / count(MOTIVO_ALLARME) ELSE 0.0 END AS pct_interpol
  FROM alarms WHERE ROTTA IS NOT NULL AND DATA_PARTENZA IS NOT NULL GROUP BY ALL)
SELECT ROTTA, month, CAST(n_alarms AS BIGINT) AS n_alarms, round(pct_interpol, 6) AS pct_interpol,
  CAST(lag(n_alarms) OVER (PARTITION BY ROTTA ORDER BY month) AS BIGINT) AS prev_n_alarms,
  round(pct_interpol - lag(pct_interpol) OVER (PARTITION BY ROTTA ORDER BY month), 6) AS delta_pct_interpol,
  coalesce(abs(pct_interpol - lag(pct_interpol) OVER (PARTITION BY ROTTA ORDER BY month)) >= 0.2, false) AS drift FROM g""")
def q_monthly_drift(spark, sf_dir):
    """Month-over-month INTERPOL-share drift per route (lag over each route's months)."""
    return DR.monthly_drift(_alarms(spark, sf_dir))


@register("scorecard")
def q_scorecard(spark, sf_dir):
    """One-record scorecard of the four-detector run."""
    return ST.scorecard(_full_scored(spark, sf_dir))


@register("risk_pipeline_supplier_grain")
def q_risk_pipeline_supplier_grain(spark, sf_dir):
    """D2–D11 + R1–R9 with routes keyed on (supplier, customer nation): the same pipeline
    over many more entities (detectors, kNN blocks and forest sampling at entity scale)."""
    r = risk_pipeline(proxy.alarm_feed(spark, sf_dir, "supplier"), proxy.traveller_feed(spark, sf_dir, "supplier")).risk
    return r.withColumn("risk_drivers", F.array_join("risk_drivers", " | ")).select(*_FULL_COLS)


@register("silhouette_moments", _LAB_SQL + """, pd AS (SELECT a.ROTTA, a.lab AS la, b.lab AS lb, """ + " + ".join(
    f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in FEATS) + """ AS d FROM lab a JOIN lab b ON a.ROTTA <> b.ROTTA),
pp AS (SELECT ROTTA, avg(CASE WHEN la = lb THEN d END) AS a, avg(CASE WHEN la <> lb THEN d END) AS b, count_if(la = lb) AS na FROM pd GROUP BY ROTTA)
SELECT round(avg(CASE WHEN na = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette_squared, CAST(count(*) AS BIGINT) AS n FROM pp""")
def q_silhouette_moments(spark, sf_dir):
    """Squared-Euclidean silhouette of the anomalous / normal split from cluster moments, in linear time."""
    r = _risk_zonly(spark, sf_dir)
    pts = standard_scale(r.select("ROTTA", *FEATS), FEATS).join(
        r.select("ROTTA", F.when(F.col("anomaly_label") != "NORMAL", "1").otherwise("0").alias("lab")), on="ROTTA")
    return ST.silhouette_moments(pts, FEATS, "lab")


_INDICATORS = ["tot_allarmi_log", "pct_interpol", "pct_sdi", "pct_nsis", "score_rischio_esiti", "tasso_chiusura", "tasso_respinti"]


@register("alert_profiles", RISK_SQL + ", " + _classic_cte() + f""", p AS (SELECT r.*, c.n_anomalie,
  concat_ws(' | ', {', '.join(f"CASE WHEN c.flag_{f} = 1 THEN {O.q(f)} END" for f in FEATS)}) AS flags
  FROM risk r JOIN classic c ON c.ROTTA = r.ROTTA WHERE r.final_risk IN ('CRITICAL', 'HIGH', 'MEDIUM') AND r.confidence >= 0.2)
SELECT ROTTA AS rotta, PAESE_PART AS paese_partenza, {_ZONE_SQL_LABEL} AS zona, final_risk, anomaly_label, round_even(confidence, 4) AS confidence,
  round_even(ensemble_score, 4) AS anomaly_score, round_even(br_score, 4) AS br_score, CAST(n_anomalie AS INTEGER) AS n_anomalie_baseline,
  flags AS feature_anomale, risk_drivers AS business_rules_active, CAST(trunc(tot_allarmi_sum) AS BIGINT) AS tot_allarmi,
  {', '.join(f'round_even({c}, 4) AS {c}' for c in _INDICATORS)},
  {O.case_map('final_risk', R.RECOMMENDATIONS)} AS recommendation FROM p""")
def q_alert_profiles(spark, sf_dir):
    """Nested profile of every alert route (anomalous features, active rules, indicators, advice), flattened for the row."""
    f = B.classic_baseline(_features(spark, sf_dir)).select("ROTTA", "n_anomalie", *["flag_" + c for c in FEATS])
    p = R.profiles(_risk_zonly(spark, sf_dir).join(f, "ROTTA"))
    return p.select("rotta", "paese_partenza", "zona", "final_risk", "anomaly_label", "confidence", "anomaly_score", "br_score",
                    "n_anomalie_baseline", F.array_join("feature_anomale", " | ").alias("feature_anomale"),
                    F.array_join("business_rules_active", " | ").alias("business_rules_active"), "indicators.*", "recommendation")


@register("alarm_only_days", FEEDS_SQL + """SELECT ROTTA, strftime(DATA_PARTENZA, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n_alarms
FROM alarms a WHERE ROTTA IS NOT NULL AND NOT EXISTS (SELECT 1 FROM travellers t WHERE t.ROTTA = a.ROTTA
  AND strftime(t.DATA_PARTENZA, '%Y-%m-%d') = strftime(a.DATA_PARTENZA, '%Y-%m-%d')) GROUP BY ALL""")
def q_alarm_only_days(spark, sf_dir):
    """Days on which a route has alarms but no traveller records (anti join on route and day)."""
    day = F.date_format("DATA_PARTENZA", "yyyy-MM-dd").alias("day")
    a = _alarms(spark, sf_dir).filter(F.col("ROTTA").isNotNull()).select("ROTTA", day)
    t = _trav(spark, sf_dir).select("ROTTA", day).distinct()
    return a.join(t, ["ROTTA", "day"], "left_anti").groupBy("ROTTA", "day").agg(F.count(F.lit(1)).alias("n_alarms"))


from lanewatch.plans import three_detectors  # noqa: E402, F401  (registers its queries)
