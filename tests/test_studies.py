"""Studies against brute-force pandas / NumPy computations on a small scored table."""

import hashlib

import numpy as np
import pandas as pd
import pytest

from lanewatch import constants as K
from lanewatch.operators import studies as ST
from lanewatch.operators.detectors.ensemble import effective_weights


def _avg_rank(x: np.ndarray) -> np.ndarray:
    return pd.Series(x).rank(method="average").to_numpy()


def _u(key: str, boot: int, seed: int) -> float:
    return int(hashlib.md5(f"{key}|{boot}|{seed}".encode()).hexdigest()[:8], 16) / 4294967296.0


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(7)
    n = 120
    pdf = pd.DataFrame({"ROTTA": [f"R{i:03d}" for i in range(n)],
                        "score_if": rng.random(n), "score_lof": rng.random(n), "score_z": rng.random(n),
                        "score_ae": rng.random(n), "br_score": rng.integers(0, 6, n) / 5.0})
    return spark.createDataFrame(pdf), pdf


def test_ablation_matches_brute_force(scored):
    df, pdf = scored
    got = {r["subset"]: r for r in ST.ablation(df, n_boot=20).collect()}
    assert len(got) == 9
    full_w = effective_weights(K.ENSEMBLE_WEIGHTS, ST.DETS)
    full = sum(full_w[d] * pdf[K.DETECTOR_SCORE_COLUMNS[d]] for d in ST.DETS)
    order = lambda s: pdf.assign(s=s).sort_values(["s", "ROTTA"], ascending=[False, True])["ROTTA"]
    full_top = set(order(full).head(17))
    share = {k: np.mean([_u(k, b, 42) < 0.8 for b in range(20)]) for k in pdf["ROTTA"]}
    for sub in ST.ablation_subsets():
        w = effective_weights(K.ENSEMBLE_WEIGHTS, sub)
        s = sum(w[d] * pdf[K.DETECTOR_SCORE_COLUMNS[d]] for d in ST.DETS)
        hi, med = np.percentile(s, 97), np.percentile(s, 90)
        r = got[" + ".join(sub)]
        assert r["n_high"] == int((s >= hi).sum())
        assert r["n_medium"] == int(((s >= med) & (s < hi)).sum())
        top = list(order(s).head(17))
        assert r["top17_overlap"] == pytest.approx(len(set(top) & full_top) / 17)
        rho = np.corrcoef(_avg_rank(s.to_numpy()), _avg_rank(pdf["br_score"].to_numpy()))[0, 1]
        assert r["br_rank_corr"] == pytest.approx(rho)
        assert r["stability_top17"] == pytest.approx(np.mean([share[k] for k in top]))


def test_grid_summary_finds_production(scored):
    df, _ = scored
    grid = ST.weight_grid(df, n_boot=5)
    s = ST.grid_summary(grid).first()
    assert s["n_weight_vectors"] == 969
    assert s["production_rank"] is not None and 1 <= s["production_rank"] <= 969
    assert s["best_objective"] >= s["production_objective"]


def test_shapley_values_sum_to_the_difference(spark):
    """Steps telescope: a row's values sum to p(x) - p(0); a feature the model never uses gets 0."""
    import numpy as np
    import pytest
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    from lanewatch.operators import studies as ST
    rng = np.random.default_rng(3)
    rows = [(f"r{i}", *map(float, v), int(v[0] + v[1] > 0.5)) for i, v in enumerate(rng.normal(size=(60, 3)))]
    df = spark.createDataFrame(rows, "ROTTA string, a double, b double, c double, is_anomaly int")
    df = df.withColumn("idle", F.lit(1.0))
    feats = ["a", "b", "c", "idle"]
    model, _, _ = ST.surrogate(df, feats, max_iter=5)
    got = {}
    for r in ST.shapley_attribution(df, model, feats, n_orders=8).collect():
        got.setdefault(r.ROTTA, {})[r.feature] = (r.attribution, r.error)
    zero = spark.createDataFrame([("zero", 0.0, 0.0, 0.0, 0.0)], "ROTTA string, a double, b double, c double, idle double")
    va = VectorAssembler(inputCols=feats, outputCol="_x")
    p = {r.ROTTA: r.p for r in model.transform(va.transform(df.select("ROTTA", *feats).unionByName(zero)))
         .select("ROTTA", vector_to_array("probability")[1].alias("p")).collect()}
    for k, values in got.items():
        assert sum(v for v, _ in values.values()) == pytest.approx(p[k] - p["zero"], abs=1e-9)
        assert values["idle"][0] == 0.0 and all(e >= 0 for _, e in values.values())


def test_moment_silhouette_equals_pairs(spark):
    import numpy as np
    import pytest

    from lanewatch.operators import studies as ST
    rng = np.random.default_rng(4)
    x = rng.normal(size=(50, 2)) + np.repeat([[0, 0], [3, 1], [9, 9]], [30, 19, 1], axis=0)
    lab = np.repeat(["x", "y", "z"], [30, 19, 1])
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    s = []
    for i in range(50):
        own = (lab == lab[i]) & (np.arange(50) != i)
        if not own.any():
            s.append(0.0)
            continue
        a, b = d[i, own].mean(), min(d[i, lab == c].mean() for c in set(lab) - {lab[i]})
        s.append((b - a) / max(a, b))
    df = spark.createDataFrame([(*map(float, v), str(c)) for v, c in zip(x, lab)], "a double, b double, label string")
    assert ST.silhouette_moments(df, ["a", "b"], "label").first().silhouette_squared == pytest.approx(np.mean(s))
