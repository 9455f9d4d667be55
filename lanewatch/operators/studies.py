"""Robustness, evaluation and attribution studies.

Scenarios are rows: a parameter-bounded list of scenario structs is
``explode``d next to each entity row (one pass, no join), and every metric is
an aggregation grouped by the scenario id.  Resampling uses hash-uniform
draws u(key, iteration, seed) so both this engine and an SQL restatement pick
the same rows, independent of partitioning.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewatch import constants as K
from lanewatch.functions.columns import md5_uniform, safe_corr, shuffled_position, sum_cols
from lanewatch.operators import rules as R
from lanewatch.operators.detectors import ensemble as EN
from lanewatch.operators.quantiles import quantiles, quantiles_by
from lanewatch.operators.ranks import average_rank, average_rank_by, dense_position, dense_position_by
from lanewatch.session import keep

DETS = ["IF", "LOF", "Z", "AE"]


# --------------------------------------------------------------- helpers
def _scenario_scores(scored: DataFrame, scenarios: list[dict], key: str) -> DataFrame:
    """(scenario_id, key, score, _rb): score = sum_d w_d * score_d per scenario."""
    arr = F.array(*[F.struct(F.lit(i).alias("sid"), *[F.lit(float(s["w"].get(d, 0.0))).alias(d) for d in DETS])
                    for i, s in enumerate(scenarios)])
    x = scored.select(key, *[F.coalesce(F.col(K.DETECTOR_SCORE_COLUMNS[d]), F.lit(0.0)).alias("_" + d) for d in DETS],
                      "_rb", F.explode(arr).alias("s"))
    score = sum_cols([F.col("s")[d] * F.col("_" + d) for d in DETS])
    return x.select(F.col("s.sid").alias("scenario_id"), key, score.alias("score"), "_rb")


def _top_k(ss: DataFrame, key: str, k: int) -> DataFrame:
    w = Window.partitionBy("scenario_id").orderBy(F.desc("score"), F.asc(key))
    return ss.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def sampled_share(keys: DataFrame, key: str, n_boot: int, frac: float, seed: int) -> DataFrame:
    """E8 core: share of ``n_boot`` Bernoulli(frac) resamples containing each key."""
    it = F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))).alias("boot")
    x = keys.select(key, it)
    return x.groupBy(key).agg(F.avg((md5_uniform(F.col(key), F.col("boot"), F.lit(seed)) < frac)
                                    .cast("double")).alias("share"))


def _scenario_metrics(scored: DataFrame, scenarios: list[dict], key: str, k: int, n_boot: int,
                      frac: float, seed: int, reference_sid: int | None = None, labels: bool = True) -> DataFrame:
    # the rule score is the same in every scenario: ranked once
    base = scored.withColumn("br_score", F.coalesce(F.col("br_score"), F.lit(0.0)))
    ties = average_rank(base, "br_score", key, "_rb", descending=False).select(key, "_rb")
    base = keep(base.select(key, *[K.DETECTOR_SCORE_COLUMNS[d] for d in DETS]).join(ties, key))
    ss = _scenario_scores(base, scenarios, key)
    ranked = average_rank_by(ss, "scenario_id", "score", key, "_ra")
    if labels:
        n = base.count()
        q = quantiles_by(ss, {"score": "score"}, [0.97, 0.9], ("scenario_id",), at_most=n) \
            .select("scenario_id", F.col("q")[0].alias("hi"), F.col("q")[1].alias("med"))
        counts = ranked.join(q, on="scenario_id").groupBy("scenario_id").agg(
            F.count_if(F.col("score") >= F.col("hi")).alias("n_high"),
            F.count_if((F.col("score") >= F.col("med")) & (F.col("score") < F.col("hi"))).alias("n_medium"),
            F.count_if(F.col("score") < F.col("med")).alias("n_normal"),
            safe_corr("_ra", "_rb").alias("br_rank_corr"))
    else:
        counts = ranked.groupBy("scenario_id").agg(safe_corr("_ra", "_rb").alias("br_rank_corr"))
    top = _top_k(ss, key, k)
    share = sampled_share(top.select(key).distinct(), key, n_boot, frac, seed)
    stab = top.join(share, on=key).groupBy("scenario_id").agg(F.avg("share").alias("stability"))
    out = counts.join(stab, on="scenario_id")
    if reference_sid is not None:
        ref = top.filter(F.col("scenario_id") == reference_sid).select(key)
        ov = top.join(ref, on=key).groupBy("scenario_id").agg((F.count(F.lit(1)) / F.lit(float(k))).alias("overlap"))
        out = out.join(ov, on="scenario_id", how="left").withColumn("overlap", F.coalesce("overlap", F.lit(0.0)))
    return out


# --------------------------------------------------------------- E1
def ablation_subsets() -> list[tuple[str, ...]]:
    """Detectors alone, one left out, all — every size but pairs, so none occurs twice."""
    return [s for size in (1, len(DETS) - 1, len(DETS)) for s in itertools.combinations(DETS, size)]


def ablation(scored: DataFrame, key: str = "ROTTA", k: int = K.TOP_K_STABILITY, n_boot: int = 200,
             frac: float = K.BOOT_FRACTION, seed: int = K.RANDOM_STATE) -> DataFrame:
    """Per detector subset (renormalised weights): label counts at p97/p90, top-k overlap
    with the full ensemble, Spearman with br_score, top-k stability under resampling."""
    subs = ablation_subsets()
    scen = [{"name": " + ".join(s), "w": EN.effective_weights(K.ENSEMBLE_WEIGHTS, s)} for s in subs]
    m = _scenario_metrics(scored, scen, key, k, n_boot, frac, seed, reference_sid=len(subs) - 1)
    names = F.array(*[F.lit(s["name"]) for s in scen])
    sizes = F.array(*[F.lit(len(s)) for s in subs])
    return m.select(
        F.element_at(names, F.col("scenario_id") + 1).alias("subset"),
        F.element_at(sizes, F.col("scenario_id") + 1).alias("n_detectors"),
        "n_high", "n_medium", "n_normal", F.col("overlap").alias(f"top{k}_overlap"),
        "br_rank_corr", F.col("stability").alias(f"stability_top{k}"))


# --------------------------------------------------------------- E2 / W10
def simplex_grid(steps: int = K.GRID_STEPS) -> list[tuple[int, int, int, int]]:
    """Integer coordinates (a, b, c, d), all >= 1, summing to ``steps`` (969 for 20)."""
    return [(a, b, c, steps - a - b - c) for a in range(1, steps) for b in range(1, steps - a)
            for c in range(1, steps - a - b) if steps - a - b - c >= 1]


def weight_grid(scored: DataFrame, key: str = "ROTTA", steps: int = K.GRID_STEPS, k: int = K.TOP_K_STABILITY,
                n_boot: int = 200, frac: float = K.BOOT_FRACTION, stability_weight: float = 0.5,
                seed: int = K.RANDOM_STATE) -> DataFrame:
    """Every weight vector on the simplex grid: stability, Spearman with br_score,
    objective = sw * stability + (1 - sw) * (rho + 1) / 2, ranked (ties by coordinates)."""
    grid = simplex_grid(steps)
    scen = [{"w": dict(zip(DETS, [c / steps for c in g]))} for g in grid]
    m = _scenario_metrics(scored, scen, key, k, n_boot, frac, seed, labels=False)
    coords = F.array(*[F.array(*[F.lit(c) for c in g]) for g in grid])
    g = F.element_at(coords, F.col("scenario_id") + 1)
    rho = F.coalesce(F.col("br_rank_corr"), F.lit(0.0))
    out = m.select(*[g[i].alias(f"c_{d.lower()}") for i, d in enumerate(DETS)],
                   *[(g[i] / F.lit(float(steps))).alias(f"w_{d.lower()}") for i, d in enumerate(DETS)],
                   "stability", rho.alias("br_rank_corr"),
                   (stability_weight * F.col("stability") + (1 - stability_weight) * (rho + 1) / 2).alias("objective"))
    # vectors with equal rankings tie, whatever the order of summation did to the last digits
    w = Window.orderBy(F.desc(F.round("objective", 9)), *[F.col(f"c_{d.lower()}") for d in DETS])
    return out.withColumn("rank", F.row_number().over(w))  # grid size is bounded by ``steps``


def grid_summary(grid: DataFrame, weights: dict | None = None, steps: int = K.GRID_STEPS) -> DataFrame:
    """Best vector vs the production weights (matched on integer coordinates)."""
    w = weights or K.ENSEMBLE_WEIGHTS
    prod = [int(round(w[d] * steps)) for d in DETS]
    is_prod = sum_cols([(F.col(f"c_{d.lower()}") == c).cast("int") for d, c in zip(DETS, prod)]) == 4
    return grid.agg(
        F.count(F.lit(1)).alias("n_weight_vectors"),
        F.max("objective").alias("best_objective"),
        F.min_by(F.struct(*[F.col(f"w_{d.lower()}") for d in DETS]), F.col("rank")).alias("best_weights"),
        F.max(F.when(is_prod, F.col("objective"))).alias("production_objective"),
        F.max(F.when(is_prod, F.col("rank"))).alias("production_rank"),
        F.min("objective").alias("worst_objective"),
    ).withColumn("best_minus_production", F.col("best_objective") - F.col("production_objective"))


def marginal_max(grid: DataFrame, a: str = "w_if", b: str = "w_z") -> DataFrame:
    """Best objective for each (a, b) weight pair (max over the other two)."""
    return grid.groupBy(a, b).agg(F.max("objective").alias("max_objective"))


# --------------------------------------------------------------- E3 / E4 / E5
def sensitivity_scenarios(thresholds: dict | None = None, deltas=None) -> list[dict]:
    """Every threshold under every relative change, the others at their base value."""
    base = dict(thresholds or K.RULE_THRESHOLDS)
    grid = itertools.product(base, deltas or K.SENSITIVITY_DELTAS)
    moved = [(name, delta, base[name] * (1 + delta)) for name, delta in grid]
    return [{"threshold": name, "baseline_value": base[name], "delta_pct": delta, "perturbed_value": value,
             "t": base | {name: value}} for name, delta, value in moved]


def threshold_sensitivity(scored: DataFrame, thresholds: dict | None = None, deltas=None) -> DataFrame:
    """Tier counts when each rule threshold is perturbed by each delta (6 x 5 = 30 rows)."""
    scen = sensitivity_scenarios(thresholds, deltas)
    counts = R.rule_what_if(scored, [s["t"] for s in scen])
    meta = F.array(*[F.struct(F.lit(s["threshold"]).alias("threshold"), F.lit(float(s["baseline_value"])).alias("baseline_value"),
                              F.lit(float(s["delta_pct"])).alias("delta_pct"),
                              F.lit(float(s["perturbed_value"])).alias("perturbed_value")) for s in scen])
    m = F.element_at(meta, F.col("scenario_id") + 1)
    return counts.select("scenario_id", m["threshold"].alias("threshold"), m["baseline_value"].alias("baseline_value"),
                         m["delta_pct"].alias("delta_pct"), m["perturbed_value"].alias("perturbed_value"),
                         *[F.col(t).cast("bigint").alias(t) for t in K.RISK_TIERS])


def sensitivity_summary(sens: DataFrame) -> DataFrame:
    """Per threshold, max |change| of CRITICAL + HIGH versus delta 0, and its percent."""
    hr = F.col("CRITICAL") + F.col("HIGH")
    g = sens.groupBy("threshold").agg(F.max(F.when(F.col("delta_pct") == 0, hr)).alias("baseline_high_risk"),
                                      F.max(hr).alias("_mx"), F.min(hr).alias("_mn"))
    swing = F.greatest(F.col("_mx") - F.col("baseline_high_risk"), F.col("baseline_high_risk") - F.col("_mn"))
    return g.select("threshold", "baseline_high_risk", swing.alias("max_abs_swing"),
                    F.round(100 * swing / F.greatest(F.col("baseline_high_risk"), F.lit(1)), 1).alias("swing_pct_of_baseline"))


def sensitivity_matrix(sens: DataFrame, tier: str = "HIGH") -> DataFrame:
    """Threshold x delta matrix for one tier (explicit pivot values)."""
    deltas = [float(d) for d in K.SENSITIVITY_DELTAS]
    return sens.groupBy("threshold").pivot("delta_pct", deltas).agg(F.first(tier))


def label_threshold_grid(scored: DataFrame, highs=(0.30, 0.35, 0.40, 0.45, 0.50), mediums=(0.15, 0.20, 0.25),
                         score_col: str = "ensemble_score") -> DataFrame:
    """E5: label counts and alert share for HIGH x MEDIUM cut-offs (plus the data-driven p97/p90 pair)."""
    hi, med = quantiles(scored, {"s": score_col}, [0.97, 0.9])["s"]
    hs = [F.lit(float(h)) for h in highs] + [F.round(F.lit(hi).cast("double"), 3)]
    ms = [F.lit(float(m)) for m in mediums] + [F.round(F.lit(med).cast("double"), 3)]
    pairs = F.array(*[F.struct(h.alias("high_t"), m.alias("medium_t")) for h in hs for m in ms])
    s = F.col(score_col)
    x = (scored.select(s.alias("s"), F.explode(pairs).alias("p"))
               .select("s", F.col("p.high_t").alias("high_t"), F.col("p.medium_t").alias("medium_t"))
               .filter(F.col("medium_t") < F.col("high_t")))
    g = x.groupBy("high_t", "medium_t").agg(
        F.count_if(F.col("s") >= F.col("high_t")).alias("n_high"),
        F.count_if((F.col("s") >= F.col("medium_t")) & (F.col("s") < F.col("high_t"))).alias("n_medium"),
        F.count_if(F.col("s") < F.col("medium_t")).alias("n_normal"),
        F.count(F.lit(1)).alias("_n"))
    return g.withColumn("alert_pct", F.round(100 * (F.col("n_high") + F.col("n_medium")) / F.col("_n"), 1)).drop("_n")


# --------------------------------------------------------------- E6
def bootstrap_ci(aligned: DataFrame, key: str = "ROTTA", n_iter: int = 1000, frac: float = K.BOOT_FRACTION,
                 seed: int = K.RANDOM_STATE) -> DataFrame:
    """Subsample bootstrap (exact-k without replacement, k = max(2, floor(n * frac)))
    of label agreement, Pearson and Spearman between two aligned runs.

    Membership: the k rows with the smallest md5(key|iter|seed) in each iteration.
    Output: metric, point, mean, std (ddof 1), lo_95, hi_95, ci_width.
    """
    n = aligned.count()
    k = max(2, int(n * frac))
    it = F.explode(F.sequence(F.lit(0), F.lit(n_iter - 1))).alias("it")
    x = aligned.select(key, "score_a", "score_b", "label_a", "label_b", it)
    h = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col("it").cast("string"), F.lit(str(seed))))
    x = dense_position_by(x.withColumn("_h", h), "it", [F.col("_h"), F.col(key)], "_rn")
    x = x.filter(F.col("_rn") <= k).drop("_h", "_rn")
    x = average_rank_by(x, "it", "score_a", key, "_ra")
    x = average_rank_by(x, "it", "score_b", key, "_rb")
    per = x.groupBy("it").agg(F.avg((F.col("label_a") == F.col("label_b")).cast("double")).alias("agreement"),
                              F.corr("score_a", "score_b").alias("pearson"), F.corr("_ra", "_rb").alias("spearman"))
    full = average_rank_by(aligned.withColumn("_p", F.lit(0)), "_p", "score_a", key, "_ra")
    full = average_rank_by(full, "_p", "score_b", key, "_rb")
    point = EN.one_row(full.agg(F.avg((F.col("label_a") == F.col("label_b")).cast("double")).alias("agreement"),
                                F.corr("score_a", "score_b").alias("pearson"), F.corr("_ra", "_rb").alias("spearman")))
    stats = per.agg(*[e for m in ("agreement", "pearson", "spearman") for e in (
        F.avg(m).alias(f"{m}_mean"), F.stddev_samp(m).alias(f"{m}_std"),
        F.percentile(m, 0.025).alias(f"{m}_lo"), F.percentile(m, 0.975).alias(f"{m}_hi"))])
    rows = [F.struct(F.lit(m).alias("metric"), point[m].alias("point"), F.col(f"{m}_mean").alias("mean"),
                     F.col(f"{m}_std").alias("std"), F.col(f"{m}_lo").alias("lo_95"), F.col(f"{m}_hi").alias("hi_95"),
                     (F.col(f"{m}_hi") - F.col(f"{m}_lo")).alias("ci_width"),
                     F.lit(n_iter).alias("n_iter"), F.lit(frac).alias("sample_frac"))
            for m in ("agreement", "pearson", "spearman")]
    return stats.select(F.inline(F.array(*rows)))


# --------------------------------------------------------------- E8
def topk_stability(scored: DataFrame, score_col: str = "ensemble_score", key: str = "ROTTA",
                   k: int = K.TOP_K_STABILITY, n_boot: int = 200, frac: float = K.BOOT_FRACTION,
                   seed: int = K.RANDOM_STATE) -> DataFrame:
    """Mean share of the top-k set kept in a frac-resample (scores are not refit, so a
    base top-k row stays in the resample's top-k exactly when it is drawn)."""
    top = scored.orderBy(F.desc(score_col), F.asc(key)).limit(k).select(key)
    share = sampled_share(top, key, n_boot, frac, seed)
    return share.agg(F.avg("share").alias("stability"), F.lit(k).alias("k"), F.lit(n_boot).alias("n_boot"))


# --------------------------------------------------------------- E9 / E10
def refit_stability(scaled: DataFrame, features, labels: DataFrame, key: str = "ROTTA", n_iter: int = 100,
                    frac: float = K.BOOT_FRACTION, n_trees: int = K.N_TREES, contamination: float = K.CONTAMINATION,
                    seed: int = K.RANDOM_STATE, stable: float = K.STABLE_SHARE, block: int = 100_000,
                    in_sample: bool = False) -> DataFrame:
    """Refit the forest on n_iter frac-subsamples (one level-wise job over
    (iteration, tree) groups), flag every entity per iteration above the (1 - c)
    quantile of that iteration's scores, report the flag frequency and stability.
    ``in_sample``: each refit flags its own subsample only; the frequency is then per appearance."""
    from lanewatch.operators.detectors import iforest as IF
    it = F.explode(F.sequence(F.lit(0), F.lit(n_iter - 1))).alias("it")
    rows = scaled.select(key, *features, it)
    sub = rows.filter(md5_uniform(F.col(key), F.col("it"), F.lit(seed)) < frac)
    nodes = IF.fit(sub, list(features), key=key, n_trees=n_trees, max_samples=K.MAX_SAMPLES, seed=seed, group_col="it")
    schema = T.StructType([T.StructField("it", T.IntegerType()), scaled.schema[key],
                           T.StructField("s", T.DoubleType())])
    feats = list(features)

    def score_group(nodes_pdf: pd.DataFrame, rows_pdf: pd.DataFrame) -> pd.DataFrame:
        if len(rows_pdf) == 0 or len(nodes_pdf) == 0:
            return pd.DataFrame({"it": [], key: [], "s": []})
        psi = int(nodes_pdf["psi"].iloc[0])
        h = IF.path_lengths(rows_pdf[feats].to_numpy(dtype=float), IF._pack(nodes_pdf))
        c = float(IF.c_factor([psi])[0]) or 1.0
        return pd.DataFrame({"it": rows_pdf["it"].astype("int32"), key: rows_pdf[key], "s": np.power(2.0, -h / c)})

    # rows are scored in blocks: a group holds one forest and at most about ``block`` rows
    blocks = max(1, -(-scaled.count() // block))
    each = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("blk")
    all_rows = rows.withColumn("blk", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
    scores = keep(nodes.select("*", each).groupBy("it", "blk").cogroup(all_rows.groupBy("it", "blk"))
                  .applyInPandas(score_group, schema))
    # the contamination threshold belongs to the rows the forest was fitted on
    fitted = scores.filter(md5_uniform(F.col(key), F.col("it"), F.lit(seed)) < frac)
    thr = quantiles_by(fitted, {"s": "s"}, [1 - contamination], ("it",)).select("it", F.col("q")[0].alias("t"))
    flagged = (fitted if in_sample else scores).join(thr, on="it").withColumn("flag", (F.col("s") > F.col("t")).cast("double"))
    freq = flagged.groupBy(key).agg(F.round(F.avg("flag"), 4).alias("bootstrap_frequency"))
    return (labels.select(key, "anomaly_label").join(freq, on=key, how="left")
                  .withColumn("is_stable", (F.col("bootstrap_frequency") >= stable).cast("int")))


def stability_consistency(stab: DataFrame, key: str = "ROTTA") -> DataFrame:
    """How many ML anomalies are refit-stable, and the stable set's overlap with them."""
    anom = F.col("anomaly_label").isin("HIGH", "MEDIUM")
    st = F.col("is_stable") == 1
    return stab.agg(F.count_if(anom).alias("n_anomalies"), F.count_if(st).alias("n_stable"),
                    F.count_if(anom & st).alias("n_stable_anomalies"),
                    F.count_if(st & ~anom).alias("n_stable_not_anomalous"))


# --------------------------------------------------------------- E11
def cluster_indices(points: DataFrame, features, label: str, key: str = "ROTTA") -> DataFrame:
    """E11 (linear part): Davies–Bouldin and Calinski–Harabasz from centroid aggregates."""
    feats = list(features)
    cen = points.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in feats])
    j = points.join(F.broadcast(cen.select(label, *[F.col(c).alias("m_" + c) for c in feats])), on=label)
    d_in = F.sqrt(sum_cols([(F.col(c) - F.col("m_" + c)) ** 2 for c in feats]))
    sq_in = sum_cols([(F.col(c) - F.col("m_" + c)) ** 2 for c in feats])
    disp = j.groupBy(label).agg(F.avg(d_in).alias("s"), F.sum(sq_in).alias("w"))
    cs = cen.join(disp, on=label).collect()  # one row per label: bounded by the label set
    kk = len(cs)
    n = sum(r["n"] for r in cs)
    if kk < 2:
        return points.sparkSession.createDataFrame([(None, None, kk)], "davies_bouldin double, calinski_harabasz double, k int")
    cents = np.array([[r[c] for c in feats] for r in cs])
    s = np.array([r["s"] for r in cs])
    db = np.mean([max((s[i] + s[j]) / np.linalg.norm(cents[i] - cents[j]) for j in range(kk) if j != i)
                  for i in range(kk)])
    g = points.select(*[F.col(c) for c in feats]).agg(*[F.avg(c).alias(c) for c in feats]).first()
    gvec = np.array([g[c] for c in feats])
    bss = sum(r["n"] * float(np.sum((np.array([r[c] for c in feats]) - gvec) ** 2)) for r in cs)
    wss = sum(r["w"] for r in cs)
    ch = (bss / (kk - 1)) / (wss / (n - kk)) if wss > 0 else None
    return points.sparkSession.createDataFrame([(float(db), None if ch is None else float(ch), kk)],
                                               "davies_bouldin double, calinski_harabasz double, k int")


def silhouette(points: DataFrame, features, label: str, key: str = "ROTTA", block_size: int = 4096) -> DataFrame:
    """Exact mean silhouette (Euclidean), blocked pairwise distance sums per label."""
    import math
    feats = list(features)
    n = points.count()
    nb = max(1, math.ceil(n / block_size))
    base = points.select(F.col(key).cast("string").alias("_id"), F.col(label).cast("string").alias("_lab"),
                         *[F.col(c).cast("double") for c in feats])
    base = base.withColumn("_blk", F.pmod(F.xxhash64("_id"), F.lit(nb)).cast("int"))
    seq = F.sequence(F.lit(0), F.lit(nb - 1))
    q = base.select("*", F.lit(0).alias("_role"), F.col("_blk").alias("_qb"), F.explode(seq).alias("_rb"))
    r = base.select("*", F.lit(1).alias("_role"), F.explode(seq).alias("_qb"), F.col("_blk").alias("_rb"))

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        Q, Rr = pdf[pdf["_role"] == 0], pdf[pdf["_role"] == 1]
        if len(Q) == 0 or len(Rr) == 0:
            return pd.DataFrame({"_id": [], "_lab": [], "other": [], "dsum": [], "cnt": []})
        qx, rx = Q[feats].to_numpy(float), Rr[feats].to_numpy(float)
        acc = np.zeros((len(qx), len(rx)))
        for j in range(len(feats)):
            d = qx[:, j:j + 1] - rx[None, :, j]
            acc = acc + d * d
        dist = np.sqrt(acc)
        same = Q["_id"].to_numpy()[:, None] == Rr["_id"].to_numpy()[None, :]
        out = []
        for lab in np.unique(Rr["_lab"].to_numpy()):
            m = (Rr["_lab"].to_numpy() == lab)[None, :] & ~same
            out.append(pd.DataFrame({"_id": Q["_id"].to_numpy(), "_lab": Q["_lab"].to_numpy(), "other": lab,
                                     "dsum": (dist * m).sum(axis=1), "cnt": m.sum(axis=1).astype("int64")}))
        return pd.concat(out)

    schema = "_id string, _lab string, other string, dsum double, cnt long"
    part = q.unionByName(r).groupBy("_qb", "_rb").applyInPandas(sums, schema)
    per = part.groupBy("_id", "_lab", "other").agg(F.try_divide(F.sum("dsum"), F.sum("cnt")).alias("mean_d"),
                                                   F.sum("cnt").alias("cnt"))
    a = per.filter(F.col("_lab") == F.col("other")).select("_id", F.col("mean_d").alias("a"), F.col("cnt").alias("na"))
    b = per.filter(F.col("_lab") != F.col("other")).groupBy("_id").agg(F.min("mean_d").alias("b"))
    s = a.join(b, on="_id").select(F.when(F.col("na") == 0, F.lit(0.0))
                                   .otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b")).alias("s"))
    return s.agg(F.avg("s").alias("silhouette"), F.count(F.lit(1)).alias("n"))


def silhouette_moments(points: DataFrame, features, label: str) -> DataFrame:
    """E11 in linear time: mean silhouette on squared Euclidean distances, from the clusters' moments.

    The mean squared distance of x to a cluster is |x|^2 - 2 x.m + s, with the cluster's mean m and mean square s; in
    its own cluster the sum is shared by the n - 1 others. A cluster of one counts 0. The moments (a row a cluster) are
    inlined.
    """
    feats = list(features)
    square = sum_cols([F.col(c) * F.col(c) for c in feats])
    base = points.select(F.col(label).cast("string").alias("_lab"), *[F.col(c).cast("double") for c in feats]) \
        .withColumn("_sq", square)
    base = keep(base)
    moments = base.groupBy("_lab").agg(F.count(F.lit(1)).alias("n"), F.avg("_sq").alias("s"),
                                       F.array(*[F.avg(c) for c in feats]).alias("m"))
    cells = F.array(*[F.struct(F.lit(r["_lab"]).alias("_lab"), F.lit(r["n"]).alias("n"), F.lit(r["s"]).alias("s"),
                               F.array(*[F.lit(v) for v in r["m"]]).alias("m")) for r in moments.collect()])
    x = F.array(*[F.col(c) for c in feats])
    dot = lambda m: F.aggregate(F.zip_with("_x", m, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    total = base.withColumn("_x", x).withColumn("cells", cells) \
        .withColumn("_d", F.transform("cells", lambda c: F.struct(
            (c["_lab"] == F.col("_lab")).alias("own"), c["n"].alias("n"),
            (F.col("_sq") - 2 * dot(c["m"]) + c["s"]).alias("d"))))
    own = F.element_at(F.filter("_d", lambda d: d["own"]), 1)
    other = F.array_min(F.transform(F.filter("_d", lambda d: ~d["own"]), lambda d: d["d"]))
    a = F.when(own["n"] > 1, own["d"] * own["n"] / (own["n"] - 1))
    s = F.when(own["n"] == 1, 0.0).when(F.greatest(a, other) > 0, (other - a) / F.greatest(a, other)).otherwise(0.0)
    return total.agg(F.avg(F.when(other.isNotNull(), s)).alias("silhouette_squared"), F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------- E12 / E13
def permuted_scenarios(scaled: DataFrame, features, key: str = "ROTTA", n_perms: int = 1,
                       seed: int = K.RANDOM_STATE) -> DataFrame:
    """Rows x (feature, permutation) scenarios with that feature shuffled across rows.

    Rows are numbered once in order of the key. In a scenario the row at position i takes the
    feature's value from position ``shuffled_position(i)``, a bijection keyed by the scenario, so
    nothing is sorted per scenario: donors come by one equi-join on the position.
    """
    feats = list(features)
    numbered = keep(dense_position(scaled.select(key, *feats), [F.col(key)], "_i").withColumn("_i", F.col("_i") - 1))
    n = numbered.count()
    scen = F.array(*[F.struct(F.lit(j * n_perms + p).alias("sid"), F.lit(j).alias("fidx"), F.lit(p).alias("perm"))
                     for j in range(len(feats)) for p in range(n_perms)])
    x = numbered.select(key, *feats, "_i", F.explode(scen).alias("sc")).select(key, *feats, "_i", "sc.sid", "sc.fidx", "sc.perm")
    x = x.withColumn("_from", shuffled_position("_i", n, F.lit(seed), "sid"))
    donor = numbered.select(F.col("_i").alias("_at"), F.array(*[F.col(c) for c in feats]).alias("_row"))
    j = x.join(donor, F.col("_from") == F.col("_at")).withColumn("_v", F.get("_row", F.col("fidx")))
    names = F.array(*[F.lit(c) for c in feats])
    return j.select("sid", F.element_at(names, F.col("fidx") + 1).alias("feature"), "perm", key,
                    *[F.when(F.col("fidx") == i, F.col("_v")).otherwise(F.col(c)).alias(c)
                      for i, c in enumerate(feats)])


def permutation_importance(scaled: DataFrame, forest: DataFrame, features, key: str = "ROTTA",
                           seed: int = K.RANDOM_STATE) -> DataFrame:
    """Change of the mean isolation score after shuffling one feature."""
    from lanewatch.operators.detectors import iforest as IF
    feats = list(features)
    base = EN.one_row(IF.score(scaled, forest, feats, key=key).agg(F.avg("if_score").alias("m")))["m"]
    p = permuted_scenarios(scaled, feats, key, 1, seed)
    s = IF.score(p, forest, feats, key=key, keep=["sid", "feature"])
    return s.groupBy("feature").agg(F.round(F.avg("if_score") - base, 6).alias("importance"))


def topset_turnover(scaled: DataFrame, forest: DataFrame, features, key: str = "ROTTA", n_perms: int = 30,
                    top_frac: float = 0.10, seed: int = K.RANDOM_STATE) -> DataFrame:
    """Mean turnover of the top-10 % set when one feature is permuted (n_perms times)."""
    from lanewatch.operators.detectors import iforest as IF
    feats = list(features)
    n = scaled.count()
    top_n = max(1, int(top_frac * n))
    ranked = dense_position(IF.score(scaled, forest, feats, key=key), [F.desc("if_score"), F.asc(key)], "_r")
    base_top = ranked.filter(F.col("_r") <= top_n).select(key)
    p = permuted_scenarios(scaled, feats, key, n_perms, seed)
    s = IF.score(p, forest, feats, key=key, keep=["sid", "feature"])
    top = dense_position_by(s, "sid", [F.desc("if_score"), F.asc(key)], "_r").filter(F.col("_r") <= top_n)
    kept = top.join(base_top.withColumn("_b", F.lit(1)), on=key, how="left")
    per = kept.groupBy("sid", "feature").agg((1.0 - F.count("_b") / F.lit(float(top_n))).alias("turnover"))
    return per.groupBy("feature").agg(F.avg("turnover").alias("importance"))


# --------------------------------------------------------------- E14 / E15
def surrogate(points: DataFrame, features, label_col: str = "is_anomaly", seed: int = K.RANDOM_STATE,
              max_iter: int = 100, max_depth: int = 4):
    """Gradient-boosted trees fitted to the ML labels; returns (model, importances, accuracy)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=list(features), outputCol="_x")
    data = va.transform(points.withColumn("_y", F.col(label_col).cast("double")))
    model = GBTClassifier(featuresCol="_x", labelCol="_y", maxIter=max_iter, maxDepth=max_depth, seed=seed).fit(data)
    pred = model.transform(data)
    acc = pred.agg(F.avg((F.col("prediction") == F.col("_y")).cast("double")).alias("accuracy"))
    imp = model.featureImportances.toArray().tolist()
    spark = points.sparkSession
    imps = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    return model, imps, acc


def zeroing_attribution(points: DataFrame, model, features, key: str = "ROTTA") -> DataFrame:
    """Per row and feature, p(x) - p(x with the feature set to 0), in one transform over
    rows x (features + 1) variants produced by explode."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    feats = list(features)
    variants = F.explode(F.sequence(F.lit(-1), F.lit(len(feats) - 1))).alias("_v")
    x = points.select(key, *feats, variants)
    x = x.select(key, "_v", *[F.when(F.col("_v") == i, F.lit(0.0)).otherwise(F.col(c)).alias(c)
                              for i, c in enumerate(feats)])
    va = VectorAssembler(inputCols=feats, outputCol="_x")
    p = model.transform(va.transform(x)).select(key, "_v", vector_to_array("probability")[1].alias("p"))
    base = p.filter(F.col("_v") == -1).select(key, F.col("p").alias("p0"))
    names = F.array(*[F.lit(c) for c in feats])
    return (p.filter(F.col("_v") >= 0).join(base, on=key)
             .select(key, F.element_at(names, F.col("_v") + 1).alias("feature"), (F.col("p0") - F.col("p")).alias("attribution")))


def shapley_attribution(points: DataFrame, model, features, key: str = "ROTTA", n_orders: int = 20,
                        seed: int = K.RANDOM_STATE) -> DataFrame:
    """E15, higher fidelity: sampled Shapley values of the surrogate's probability against the all-zero row.

    Features are switched on one after another in ``n_orders`` random orders (each also backwards, which cancels much of
    the noise); a feature's value is the mean step that it makes. Steps of one order telescope, so the values of a row
    sum to p(x) - p(0) whatever the sample; ``error`` is the standard error of each value over the orders. One transform
    over rows x orders x (features + 1) variants. Output: key, feature, attribution, error.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    feats, rng = list(features), np.random.default_rng(seed)
    half = [rng.permutation(len(feats)).tolist() for _ in range(max(1, n_orders // 2))]
    orders = [o for one in half for o in (one, one[::-1])]
    place = F.array(*[F.array(*[F.lit(o.index(j)) for j in range(len(feats))]) for o in orders])
    by_step = F.array(*[F.array(*[F.lit(feats[j]) for j in o]) for o in orders])
    variants = F.explode(F.sequence(F.lit(0), F.lit(len(orders) * (len(feats) + 1) - 1))).alias("_v")
    x = points.select(key, *feats, variants).withColumn("_o", F.floor(F.col("_v") / (len(feats) + 1)).cast("int")) \
        .withColumn("_step", F.pmod("_v", F.lit(len(feats) + 1)).cast("int")).withColumn("_place", F.get(place, F.col("_o")))
    x = x.select(key, "_o", "_step", *[F.when(F.col("_place")[j] < F.col("_step"), F.col(c)).otherwise(0.0).alias(c)
                                       for j, c in enumerate(feats)])
    p = model.transform(VectorAssembler(inputCols=feats, outputCol="_x").transform(x)) \
        .select(key, "_o", "_step", vector_to_array("probability")[1].alias("p"))
    walks = p.groupBy(key, "_o").agg(F.sort_array(F.collect_list(F.struct("_step", "p"))).alias("w"))       # features + 1 numbers
    steps = walks.select(key, F.posexplode(F.transform(F.slice("w", 2, len(feats)), lambda s, i: F.struct(
        F.get(F.get(by_step, F.col("_o")), i).alias("feature"), (s["p"] - F.get("w", i)["p"]).alias("d")))).alias("_i", "_s"))
    return steps.groupBy(key, F.col("_s.feature").alias("feature")).agg(
        F.avg("_s.d").alias("attribution"), (F.stddev_samp("_s.d") / np.sqrt(len(orders))).alias("error"))


def global_attribution(attr: DataFrame) -> DataFrame:
    """Mean |attribution| per feature."""
    return attr.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs_attribution"))


def top_attributions(attr: DataFrame, key: str = "ROTTA", k: int = 3) -> DataFrame:
    """Each row's k features with the largest |attribution| (window per entity)."""
    w = Window.partitionBy(key).orderBy(F.desc(F.abs("attribution")), F.asc("feature"))
    return attr.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


# --------------------------------------------------------------- E16
def scorecard(risk: DataFrame, key: str = "ROTTA", score_col: str = "ensemble_score", k: int = K.TOP_K_STABILITY,
              n_boot: int = 200, seed: int = K.RANDOM_STATE) -> DataFrame:
    """One record with the run's headline metrics (label and tier counts, thresholds,
    alert volume, top entity, top-k stability)."""
    stab = EN.one_row(topk_stability(risk, score_col, key, k, n_boot, K.BOOT_FRACTION, seed).select("stability"))
    high, medium = quantiles(risk, {"s": score_col}, [K.LABEL_QUANTILE_HIGH, K.LABEL_QUANTILE_MEDIUM])["s"]
    return risk.agg(
        F.count(F.lit(1)).alias("n_routes"),
        *[F.count_if(F.col("anomaly_label") == lbl).alias(f"n_{lbl.lower()}_label") for lbl in K.ANOMALY_LABELS],
        *[F.count_if(F.col("final_risk") == t).alias(f"n_{t.lower()}") for t in K.RISK_TIERS],
        F.lit(high).cast("double").alias("threshold_high"), F.lit(medium).cast("double").alias("threshold_medium"),
        F.count_if(F.col("final_risk").isin(K.ALERT_TIERS) & (F.col("confidence") >= K.ALERT_MIN_CONFIDENCE))
        .alias("n_alerts"),
        F.avg("confidence").alias("mean_confidence"),
        F.min_by(F.col(key), F.struct(-F.col("confidence"), F.col(key))).alias("top_route"),
    ).withColumn(f"stability_top{k}", stab["stability"])
