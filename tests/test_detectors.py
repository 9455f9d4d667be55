"""Detector invariants and study shapes."""

import numpy as np
import pandas as pd
import pytest

from lanewatch.operators import studies as ST
from lanewatch.operators.detectors import autoencoder as AE
from lanewatch.operators.detectors import iforest as IF
from lanewatch.operators.detectors import lof as LOF

FEATS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3))
    x = np.vstack([x, [[8, 8, 8], [-9, 7, -8], [10, -10, 9]]])
    pdf = pd.DataFrame(x, columns=FEATS)
    pdf.insert(0, "ROTTA", [f"R{i:04d}" for i in range(len(pdf))])
    return spark.createDataFrame(pdf), pdf


PLANTED = {"R0200", "R0201", "R0202"}


def test_lof_matches_brute_force(cloud):
    df, pdf = cloud
    got = {r["ROTTA"]: r["lof"] for r in LOF.local_outlier_factor(df, FEATS, k=20, cell_rows=20).collect()}
    X = pdf[FEATS].to_numpy()
    ids = pdf["ROTTA"].to_numpy()
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    nn = np.array([np.lexsort((np.arange(len(X)), D[i]))[:20] for i in range(len(X))])
    kd = D[np.arange(len(X)), nn[:, -1]]
    reach = np.maximum(D[np.arange(len(X))[:, None], nn], kd[nn])
    lrd = 1 / (reach.mean(1) + 1e-10)
    lof = lrd[nn].mean(1) / lrd
    for i in range(len(X)):
        assert got[ids[i]] == pytest.approx(lof[i], rel=1e-9)
    top = sorted(got, key=got.get, reverse=True)[:3]
    assert set(top) == PLANTED


def _brute_knn(rows, k):
    """(key -> [(dist, nbr)]) of the k nearest, ties by key."""
    out = {}
    for a, *x in rows:
        found = sorted((float(np.sqrt(sum((p - q) ** 2 for p, q in zip(x, y)))), b) for b, *y in rows if b != a)
        out[a] = found[:k]
    return out


@pytest.mark.parametrize("cell_rows", [10_000, 60, 7])
def test_knn_with_copies_and_ties(spark, cell_rows):
    """A point that many rows share, a grid full of equal distances, and far points."""
    rng = np.random.default_rng(1)
    rows = [(f"copy{i:03d}", 1.0, 1.0) for i in range(70)] + [(f"grid{i:03d}", float(i % 12), float(i // 12)) for i in range(144)]
    rows += [(f"far{i}", *map(float, p)) for i, p in enumerate(rng.normal(0, 50, (40, 2)))] + [("zero", -0.0, 0.0)]
    df = spark.createDataFrame(rows, "ROTTA string, a double, b double").repartition(5)
    got = {}
    for r in LOF.knn(df, ["a", "b"], k=9, cell_rows=cell_rows).collect():
        got.setdefault(r.ROTTA, []).append((r["rank"], r.nbr, r.dist))
    want = _brute_knn(rows, 9)
    assert set(got) == set(want)
    for key, found in got.items():
        assert [(n, d) for _, n, d in sorted(found)] == [(n, pytest.approx(d, abs=1e-12)) for d, n in want[key]]


@pytest.mark.parametrize("n", [1, 2, 5])
def test_knn_of_few_points(spark, n):
    rows = [(f"p{i}", float(i), 0.0) for i in range(n)]
    got = LOF.knn(spark.createDataFrame(rows, "ROTTA string, a double, b double"), ["a", "b"], k=20).collect()
    assert len(got) == n * (n - 1)


def test_knn_work_per_point_does_not_grow(spark):
    """Distances computed per point stay about the same with four times the points."""
    from pyspark.sql import functions as F
    work = []
    for n in (2000, 8000):
        df = spark.range(n).select(F.format_string("p%05d", "id").alias("ROTTA"), *[
            (F.pmod(F.xxhash64("id", F.lit(j)), F.lit(1_000_003)) / 1e6).alias(c) for j, c in enumerate("abc")])
        reps = LOF._distinct(df, ["a", "b", "c"], "ROTTA", 10)
        near = LOF.nearest_points(reps, n, cell_rows=40)
        work.append(near.agg(F.sum("pairs")).first()[0] / n)
    assert work[1] < 1.5 * work[0] and work[1] < 8000 / 4


def _forest_by_hand(rows, feats, n_trees, max_samples, seed):
    """The forest's definition, tree by tree: {(tree, node): (feature, threshold, leaf value)}."""
    import hashlib
    import math

    def number(text, at):
        return int(hashlib.md5(text.encode()).hexdigest()[at:at + 8], 16)
    out, n = {}, len(rows)
    psi = min(max_samples, n)
    for t in range(n_trees):
        place = {k: (number(f"{k}|{seed}", 0) + t * number(f"{k}|{seed}", 8)) % IF.PLACES for k in rows}
        sample = sorted((p, k) for k, p in place.items() if p < 3.0 * IF.PLACES * psi / n)[:psi]
        stack = [(0, [rows[k] for _, k in sample], 0)]
        while stack:
            node, own, depth = stack.pop()
            vary = [j for j in range(len(feats)) if min(x[j] for x in own) < max(x[j] for x in own)]
            if len(own) <= 1 or depth >= math.ceil(math.log2(max(psi, 2))) or not vary:
                out[t, node] = (-1, 0.0, depth + float(IF.c_factor([len(own)])[0]))
                continue
            u, v = [(number(f"{t}|{node}|{seed}|{what}", 0) + 0.5) / 2 ** 32 for what in ("feature", "threshold")]
            f = vary[int(u * len(vary))]
            lo, hi = min(x[f] for x in own), max(x[f] for x in own)
            cut = lo + v * (hi - lo)
            cut = cut if cut > lo else hi
            out[t, node] = (f, cut, 0.0)
            stack += [(2 * node + 1, [x for x in own if x[f] < cut], depth + 1),
                      (2 * node + 2, [x for x in own if x[f] >= cut], depth + 1)]
    return out


def test_iforest_is_the_forest_grown_by_hand(cloud):
    df, pdf = cloud
    rows = {r[0]: list(r[1:]) for r in pdf.itertuples(index=False)}
    got = {(r.tree_id, r.node): (r.feature, r.threshold, r.leaf_value)
           for r in IF.fit(df, FEATS, n_trees=12, max_samples=32, seed=9).collect()}
    want = _forest_by_hand(rows, FEATS, 12, 32, 9)
    assert set(got) == set(want)
    for k, (f, cut, h) in want.items():
        assert got[k][0] == f and got[k][1] == pytest.approx(cut) and got[k][2] == pytest.approx(h)


def test_iforest_of_equal_rows_and_one_row(spark):
    """Nothing to split: one leaf a tree, every row as normal as any."""
    for n in (1, 6):
        df = spark.createDataFrame([(f"k{i}", 1.0, 2.0, 3.0) for i in range(n)], "ROTTA string, a double, b double, c double")
        nodes = IF.fit(df, FEATS, n_trees=5)
        assert [r.feature for r in nodes.collect()] == [-1] * 5
        assert len({r.if_score for r in IF.score(df, nodes, FEATS).collect()}) == 1


def test_iforest_planted_outliers_and_range(cloud):
    df, _ = cloud
    nodes = IF.fit(df, FEATS, n_trees=100, max_samples=128, seed=1)
    s = {r["ROTTA"]: r["if_score"] for r in IF.score(df, nodes, FEATS).collect()}
    assert all(0 < v <= 1 for v in s.values())
    assert set(sorted(s, key=s.get, reverse=True)[:3]) == PLANTED


def test_iforest_partition_independent(cloud):
    df, _ = cloud
    a = {r["ROTTA"]: r["if_score"] for r in IF.score(df, IF.fit(df, FEATS, n_trees=50, seed=3), FEATS).collect()}
    d2 = df.repartition(7)
    b = {r["ROTTA"]: r["if_score"] for r in IF.score(d2, IF.fit(d2, FEATS, n_trees=50, seed=3), FEATS).collect()}
    assert a == pytest.approx(b)


def test_autoencoder_scores(cloud):
    df, _ = cloud
    from pyspark.sql import functions as F
    flagged = df.withColumn("if_normal", ~F.col("ROTTA").isin(*PLANTED))
    s = {r["ROTTA"]: r["score_ae"] for r in AE.autoencoder_scores(flagged, FEATS, epochs=300).collect()}
    assert min(s.values()) == 0.0 and max(s.values()) == 1.0
    assert set(sorted(s, key=s.get, reverse=True)[:3]) == PLANTED


def test_study_shapes():
    assert len(ST.simplex_grid(20)) == 969
    assert len(ST.sensitivity_scenarios()) == 30
    assert len(ST.ablation_subsets()) == 9


def test_iforest_samples_every_group_in_full(cloud):
    """Each (resample, tree) is grown on min(psi, rows of that resample)."""
    from pyspark.sql import functions as F
    df, _ = cloud
    sizes = {0: 203, 1: 40, 2: 150}
    parts = [df.orderBy("ROTTA").limit(n).withColumn("it", F.lit(i)) for i, n in sizes.items()]
    sub = parts[0].unionByName(parts[1]).unionByName(parts[2])
    nodes = IF.fit(sub, FEATS, n_trees=30, max_samples=64, group_col="it")
    got = {(r.it, r.tree_id): (r.psi, r.n_sampled) for r in nodes.select("it", "tree_id", "psi", "n_sampled").distinct().collect()}
    assert len(got) == 90
    assert all(v == (min(64, sizes[it]), min(64, sizes[it])) for (it, _), v in got.items())


def test_refit_stability_flags_the_outliers(cloud):
    from pyspark.sql import functions as F
    df, _ = cloud
    labels = df.select("ROTTA", F.lit("HIGH").alias("anomaly_label"))
    for block in (100_000, 50):
        rows = ST.refit_stability(df, FEATS, labels, n_iter=6, n_trees=40, contamination=0.05, block=block).collect()
        freq = {r.ROTTA: r.bootstrap_frequency for r in rows}
        assert len(freq) == 203 and all(freq[k] == 1.0 for k in PLANTED)


def test_autoencoder_does_not_depend_on_partitions(cloud):
    df, _ = cloud
    one = AE.fit(df.coalesce(1), FEATS, epochs=25)
    many = AE.fit(df.repartition(6), FEATS, epochs=25)
    X = df.select(*FEATS).toPandas().to_numpy()
    sizes = [3, *AE.K.AE_HIDDEN, 3]
    a, b = (AE.reconstruction_error(X, AE.unflatten(v, sizes)) for v in (one, many))
    assert np.corrcoef(a, b)[0, 1] > 0.999


def test_autoencoder_gradient():
    rng = np.random.default_rng(0)
    X, sizes = rng.normal(size=(20, 3)), [3, 4, 2, 4, 3]
    x = AE.flatten(AE.init_params(sizes, 1))
    _, g = AE.loss_and_gradient(X, AE.unflatten(x, sizes))
    for i in range(0, len(x), 7):
        e = np.zeros(len(x))
        e[i] = 1e-6
        up, down = (AE.loss_and_gradient(X, AE.unflatten(x + s * e, sizes))[0] for s in (1, -1))
        assert g[i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-5)


def test_silhouette_of_a_single_member_cluster(spark):
    df = spark.createDataFrame([("a", 0.0, "x"), ("b", 1.0, "x"), ("c", 9.0, "y")], "ROTTA string, v double, label string")
    row = ST.silhouette(df, ["v"], "label").collect()[0]
    # a: 1 - 1/9, b: 1 - 1/8, c: a cluster of one counts 0
    assert list(row.asDict().values())[0] == pytest.approx((8 / 9 + 7 / 8 + 0) / 3)


def test_average_rank_keeps_rows_without_a_score(spark):
    from lanewatch.operators.ranks import average_rank
    df = spark.createDataFrame([("a", 3.0), ("b", None), ("c", 3.0), ("d", 1.0)], "k string, s double")
    got = {r.k: r.rank for r in average_rank(df, "s", "k", "rank").collect()}
    assert got == {"a": 1.5, "c": 1.5, "d": 3.0, "b": 4.0}


def test_autoencoder_default_runs_to_the_tolerance(cloud):
    """The default ends by the tolerance, not at a step count; a shorter fit says that it did not converge."""
    import warnings
    df, _ = cloud
    with warnings.catch_warnings():
        warnings.simplefilter("error", RuntimeWarning)
        full = AE.fit(df, FEATS)
    with pytest.warns(RuntimeWarning, match="tolerance not reached"):
        short = AE.fit(df, FEATS, epochs=5)
    X, sizes = df.select(*FEATS).toPandas().to_numpy(), [3, *AE.K.AE_HIDDEN, 3]
    a, b = (AE.loss_and_gradient(X, AE.unflatten(v, sizes))[0] for v in (full, short))
    assert a < b


def test_autoencoder_in_one_task_equals_many(cloud):
    df, _ = cloud
    one, many = AE.fit(df, FEATS, epochs=10), AE.fit(df, FEATS, epochs=10, rows_per_task=80)
    assert one == pytest.approx(many, rel=1e-4, abs=1e-6)


def test_topset_turnover_ranks_without_a_limit(cloud):
    df, _ = cloud
    nodes = IF.fit(df, FEATS, n_trees=20, max_samples=64, seed=1)
    out = ST.topset_turnover(df, nodes, FEATS, n_perms=2)
    assert "Limit" not in out._jdf.queryExecution().optimizedPlan().toString()
    def top(rows):
        return {r.ROTTA for r in sorted(rows, key=lambda r: (-r.if_score, r.ROTTA))[:20]}
    base = top(IF.score(df, nodes, FEATS).collect())
    rows = IF.score(ST.permuted_scenarios(df, FEATS, "ROTTA", 2, 42), nodes, FEATS, keep=["sid", "feature"]).collect()
    want = {f: np.mean([1 - len(top([r for r in rows if r.sid == s]) & base) / 20
                        for s in {r.sid for r in rows if r.feature == f}]) for f in FEATS}
    assert {r.feature: r.importance for r in out.collect()} == pytest.approx(want)


def test_autoencoder_evaluation_is_one_stage(cloud, monkeypatch):
    """With rows in several tasks an evaluation shuffles nothing: one job of one stage."""
    df, _ = cloud
    evaluations, real = [], AE.minimise
    monkeypatch.setattr(AE, "minimise", lambda f, *a: real(lambda v: evaluations.append(1) or f(v), *a))
    sc = df.sparkSession.sparkContext
    sc.setJobGroup("ae-evaluations", "fit")
    try:
        AE.fit(df, FEATS, epochs=20, rows_per_task=80)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = sc.statusTracker().getJobIdsForGroup("ae-evaluations")
    assert len(evaluations) >= 20 and len(jobs) <= len(evaluations) + 5     # besides: the count, dealing the rows


def test_knn_in_many_dimensions(spark):
    """Where cells hide little, neighbours are exact, every point still skips cells, and the jobs do not grow with the cells."""
    from pyspark.sql import functions as F
    names, jobs, n, k = [f"x{j}" for j in range(7)], [], 3000, 6
    df = spark.range(n).select(F.format_string("p%05d", "id").alias("ROTTA"), *[
        (F.pmod(F.xxhash64("id", F.lit(j)), F.lit(1_000_003)) / 1e6).alias(c) for j, c in enumerate(names)])
    reps = LOF._distinct(df, names, "ROTTA", k).cache()
    sc = spark.sparkContext
    for cell_rows in (300, 15):
        sc.setJobGroup(f"neighbours-{cell_rows}", "search")
        try:
            near = LOF.nearest_points(reps, n, cell_rows=cell_rows)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"neighbours-{cell_rows}")))
    assert jobs[1] <= jobs[0] + 2
    assert near.agg(F.sum("pairs")).first()[0] < 0.8 * n * n
    rows = sorted(df.collect())
    x, got = np.array([r[1:] for r in rows]), {}
    for r in LOF.knn(df, names, k=k, cell_rows=15).collect():
        got.setdefault(r.ROTTA, []).append((r["rank"], r.nbr))
    for i in range(0, n, 50):
        d = ((x - x[i]) ** 2).sum(axis=1)
        assert [b for _, b in sorted(got[rows[i].ROTTA])] == [rows[j].ROTTA for j in np.argsort(d, kind="stable")[1:k + 1]]


def test_lof_of_a_table_in_many_partitions(cloud, monkeypatch):
    """Neighbour tables do not stay in as many partitions as the input; the factors are the same."""
    df, _ = cloud
    spread, real = [], LOF.keep
    monkeypatch.setattr(LOF, "keep", lambda t: spread.append(real(t)) or spread[-1])
    got = {r.ROTTA: r.lof for r in LOF.local_outlier_factor(df.repartition(150), FEATS, k=20, cell_rows=20).collect()}
    assert max(t.rdd.getNumPartitions() for t in spread) <= 3 * df.sparkSession.sparkContext.defaultParallelism
    want = {r.ROTTA: r.lof for r in LOF.local_outlier_factor(df.coalesce(1), FEATS, k=20, cell_rows=20).collect()}
    assert got == pytest.approx(want, rel=1e-9)
