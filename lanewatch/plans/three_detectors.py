"""Queries on the forest + LOF + robust-z ensemble: every stage has a SQL restatement.

The autoencoder is left out here (weights redistributed, D9), because its training has no SQL form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lanewatch import constants as K
from lanewatch.functions.columns import round_doubles
from lanewatch.operators import baseline as B
from lanewatch.operators import rules as R
from lanewatch.operators import studies as ST
from lanewatch.operators.detectors import ensemble as EN
from lanewatch.plans import oracle_sql as O
from lanewatch.plans.catalog import register
from lanewatch.plans.pipeline import score_entities
from lanewatch.plans.queries import _FULL_COLS, FEATS, _features, _scaled
from lanewatch.plans.workspace import memo
from lanewatch.session import keep

DETECTORS = ("IF", "LOF", "Z")
WEIGHTS = EN.effective_weights(K.ENSEMBLE_WEIGHTS, DETECTORS)
COLS = {d: K.DETECTOR_SCORE_COLUMNS[d] for d in ST.DETS}


@memo(persist=True)
def _three(spark, sf_dir):
    scored, _ = score_entities(B.robust_zscores(_features(spark, sf_dir)), detectors=DETECTORS)
    return R.apply_rules(scored)


def _ensemble_cte() -> str:
    blend = " + ".join(f"{COLS[d]} * CAST({WEIGHTS[d]!r} AS DOUBLE)" for d in DETECTORS)
    votes = " + ".join(f"CAST({COLS[d]} >= {c!r} AS INTEGER)" for d, c in K.VOTE_CUTOFFS.items())
    return f"""three_m AS (SELECT b.*, f.score_if, l.score_lof, {O.minmax_expr('b.baseline_score', 'baseline b')} AS score_z, CAST(0 AS DOUBLE) AS score_ae
  FROM baseline b LEFT JOIN (SELECT ROTTA, {O.minmax_expr('if_score', 'forest')} AS score_if FROM forest) f ON f.ROTTA = b.ROTTA
  LEFT JOIN lof l ON l.ROTTA = b.ROTTA),
three_e AS (SELECT *, {O.clip(blend, 0, 1)} AS ensemble_score, {votes} AS n_models_flagged FROM three_m),
{O.quantile_label_cte('three_e', 'three', 'ensemble_score', 'anomaly_label')}"""


THREE_SQL = O.with_(O.features_cte(), O.baseline_cte(), O.scaled_cte(), O.iforest_cte("scaled", "forest"), O.lof_cte(),
                    _ensemble_cte(), O.risk_cte("three", "risk"))

_TYPES = {"n_models_flagged": "int", **dict.fromkeys(K.RULE_LABELS, "int"), **dict.fromkeys(
    ["score_if", "score_lof", "score_z", "score_ae", "ensemble_score", "br_score", "confidence"], "double")}


@register("ensemble_three_detectors", THREE_SQL + O.round_select([(c, _TYPES.get(c, "str")) for c in _FULL_COLS], "risk"))
def q_ensemble_three(spark, sf_dir):
    """Forest, LOF and robust z blended with redistributed weights, labels, votes, tiers."""
    r = _three(spark, sf_dir)
    return round_doubles(r.withColumn("risk_drivers", F.array_join("risk_drivers", " | ")).select(*_FULL_COLS))


@register("strict_pass_three_detectors", THREE_SQL + ", " + O.iforest_cte("scaled", "strict", trees=K.STRICT_N_TREES) + f""",
cut AS (SELECT quantile_cont(if_score, {1 - K.STRICT_CONTAMINATION!r}) AS t FROM strict),
sup AS (SELECT anomaly_label = 'HIGH' AS high, anomaly_label = 'HIGH' AND (if_score > t
    OR (SELECT count(*) FROM risk WHERE anomaly_label = 'HIGH') < {K.STRICT_MIN_HIGH}) AS robust
  FROM risk JOIN strict USING (ROTTA), cut),
g AS (SELECT count_if(high) AS a, count_if(robust) AS b FROM sup)
SELECT CAST(a AS BIGINT) AS n_first_pass_high, CAST(b AS BIGINT) AS n_robust_high, CAST(a - b AS BIGINT) AS n_downgraded,
  round(b / greatest(a, 1), 4) AS robustness_rate, (a - b) / greatest(a, 1) > 0.5 AS rerun_suggested FROM g""")
def q_strict_three(spark, sf_dir):
    """D12 + D13: 300-tree forest at contamination 0.03 confirms or downgrades the HIGH routes of the three-detector run."""
    sup = EN.strict_second_pass(_three(spark, sf_dir), _scaled(spark, sf_dir), FEATS, contamination=K.STRICT_CONTAMINATION,
                                n_trees=K.STRICT_N_TREES, min_high=K.STRICT_MIN_HIGH)
    return EN.supervision_summary(sup)


# ------------------------------------------------------------------ refits
REFITS, REFIT_TREES = 10, 100


def _refit_sql(in_sample: bool) -> str:
    draw = "CAST(('0x' || substr(md5(ROTTA || '|' || CAST(it AS VARCHAR) || '|42'), 1, 8)) AS BIGINT) / 4294967296.0 < 0.8"
    return THREE_SQL + f""", sub AS (SELECT s.*, it FROM scaled s, range({REFITS}) r(it) WHERE {draw}),
{O.iforest_cte("sub", "refit", trees=REFIT_TREES, group="it", score_src="scaled")},
fitted AS (SELECT refit.* FROM refit JOIN sub USING (it, ROTTA)),
cuts AS (SELECT it, quantile_cont(if_score, 0.9) AS t FROM fitted GROUP BY it),
freq AS (SELECT ROTTA, round(avg(CAST(if_score > t AS DOUBLE)), 4) AS f FROM {'fitted' if in_sample else 'refit'} JOIN cuts USING (it) GROUP BY ROTTA)
SELECT r.ROTTA, r.anomaly_label, f AS bootstrap_frequency, CAST(f >= 0.7 AS INTEGER) AS is_stable FROM risk r LEFT JOIN freq USING (ROTTA)"""


@register("refit_stability_three_detectors", _refit_sql(False))
def q_refit_three(spark, sf_dir):
    """Share of ten 100-tree refits on 80 % subsamples that flag each route, all routes predicted."""
    return ST.refit_stability(_scaled(spark, sf_dir), FEATS, _three(spark, sf_dir), n_iter=REFITS, n_trees=REFIT_TREES)


@register("refit_stability_in_sample", _refit_sql(True))
def q_refit_in_sample(spark, sf_dir):
    """E9, second variant: each refit predicts its own subsample; flags are divided by a route's appearances."""
    return ST.refit_stability(_scaled(spark, sf_dir), FEATS, _three(spark, sf_dir), n_iter=REFITS, n_trees=REFIT_TREES,
                              in_sample=True)


# --------------------------------------------------------------- scenarios
def _scenario_sql(values: str, k: int = K.TOP_K_STABILITY) -> str:
    """CTEs ``m`` (sid, n_high, n_medium, n_normal, rho, stability) and ``tops`` over weight vectors ``scen``."""
    score = " + ".join(f"w_{d.lower()} * coalesce({COLS[d]}, 0.0)" for d in ST.DETS)
    draw = "CAST(('0x' || substr(md5(ROTTA || '|' || CAST(b AS VARCHAR) || '|42'), 1, 8)) AS BIGINT) / 4294967296.0 < 0.8"
    return THREE_SQL + f""", scen AS ({values}),
base AS (SELECT *, (2 * rank() OVER (ORDER BY br_score) + count(*) OVER (PARTITION BY br_score) - 1) / 2.0 AS rb FROM risk),
ss AS (SELECT sid, ROTTA, {score} AS score, rb FROM base, scen),
rk AS (SELECT *, (2 * rank() OVER (PARTITION BY sid ORDER BY score) + count(*) OVER (PARTITION BY sid, score) - 1) / 2.0 AS ra,
  row_number() OVER (PARTITION BY sid ORDER BY score DESC, ROTTA) AS rn FROM ss),
qs AS (SELECT sid, quantile_cont(score, 0.97) AS hi, quantile_cont(score, 0.9) AS med, corr(ra, rb) AS rho FROM rk GROUP BY sid),
cs AS (SELECT sid, count_if(score >= hi) AS n_high, count_if(score >= med AND score < hi) AS n_medium, count_if(score < med) AS n_normal
  FROM rk JOIN qs USING (sid) GROUP BY sid),
tops AS (SELECT sid, ROTTA FROM rk WHERE rn <= {k}),
shares AS (SELECT ROTTA, avg(CAST({draw} AS DOUBLE)) AS share FROM (SELECT DISTINCT ROTTA FROM tops), range(200) t(b) GROUP BY ROTTA),
st AS (SELECT sid, avg(share) AS stability FROM tops JOIN shares USING (ROTTA) GROUP BY sid),
m AS (SELECT * FROM qs JOIN cs USING (sid) JOIN st USING (sid))
"""


def _ablation_sql() -> str:
    rows, k = [], K.TOP_K_STABILITY
    subsets = ST.ablation_subsets()
    for i, s in enumerate(subsets):
        w = EN.effective_weights(K.ENSEMBLE_WEIGHTS, s)
        rows.append(f"SELECT {i} AS sid, {O.q(' + '.join(s))} AS subset, {len(s)} AS n_detectors, "
                    + ", ".join(f"CAST({w[d]!r} AS DOUBLE) AS w_{d.lower()}" for d in ST.DETS))
    return _scenario_sql("\nUNION ALL ".join(rows)) + f"""SELECT subset, n_detectors, CAST(n_high AS BIGINT) AS n_high,
  CAST(n_medium AS BIGINT) AS n_medium, CAST(n_normal AS BIGINT) AS n_normal,
  round((SELECT count(*) FROM tops t WHERE t.sid = scen.sid AND t.ROTTA IN (SELECT ROTTA FROM tops WHERE sid = {len(subsets) - 1})) / {float(k)}, 6) AS top{k}_overlap,
  round(CASE WHEN isnan(rho) THEN NULL ELSE rho END, 6) AS br_rank_corr, round(stability, 6) AS stability_top{k} FROM m JOIN scen USING (sid)"""


@register("ablation_three_detectors", _ablation_sql())
def q_ablation_three(spark, sf_dir):
    """The nine detector subsets on the three-detector run (the autoencoder's scores are zero)."""
    return round_doubles(ST.ablation(_three(spark, sf_dir)))


def _grid_sql() -> str:
    n = K.GRID_STEPS
    values = f"""SELECT a * 10000 + b * 100 + c AS sid, a, b, c, {n} - a - b - c AS d, a / {float(n)} AS w_if, b / {float(n)} AS w_lof,
  c / {float(n)} AS w_z, ({n} - a - b - c) / {float(n)} AS w_ae
  FROM range(1, {n}) x(a), range(1, {n}) y(b), range(1, {n}) z(c) WHERE a + b + c < {n}"""
    return _scenario_sql(values) + f""", o AS (SELECT *, 0.5 * stability + 0.5 * (r + 1) / 2 AS objective
  FROM (SELECT *, CASE WHEN rho IS NULL OR isnan(rho) THEN 0.0 ELSE rho END AS r FROM m JOIN scen USING (sid)))
SELECT CAST(a AS INTEGER) AS c_if, CAST(b AS INTEGER) AS c_lof, CAST(c AS INTEGER) AS c_z, CAST(d AS INTEGER) AS c_ae,
  round(w_if, 6) AS w_if, round(w_lof, 6) AS w_lof, round(w_z, 6) AS w_z, round(w_ae, 6) AS w_ae, round(stability, 6) AS stability,
  round(r, 6) AS br_rank_corr, round(objective, 6) AS objective,
  CAST(row_number() OVER (ORDER BY round(objective, 9) DESC, a, b, c, d) AS INTEGER) AS rank FROM o"""


@register("weight_grid_three_detectors", _grid_sql())
def q_grid_three(spark, sf_dir):
    """All 969 weight vectors on the three-detector run."""
    return round_doubles(ST.weight_grid(_three(spark, sf_dir)))
