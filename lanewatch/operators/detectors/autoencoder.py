"""Reconstruction-error detector (dense autoencoder, ReLU).

One training rule at every size: limited-memory BFGS on the full-batch loss, to the
tolerance or AE_MAX_EPOCHS steps; a fit that ends without reaching the tolerance
warns.  Rows that fit in one task are trained on in that task, in one job.  With more,
every evaluation is one Spark job of a single stage in which each partition sums loss
and gradient over its own rows; the driver adds up one such sum a partition and holds
the parameters and a few past steps (some hundred doubles each).  The rows are packed
into small matrices once and persisted for the fit, so an evaluation plans, shuffles and
converts nothing, and a lost executor only recomputes its partitions.  Scoring broadcasts
the weights.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewatch import constants as K

#: rows of a packed matrix: a layer's activations stay in the processor's cache
BLOCK = 2048


def init_params(sizes, seed: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    params = []
    for fi, fo in zip(sizes[:-1], sizes[1:]):
        bound = math.sqrt(6.0 / (fi + fo))
        params.append(rng.uniform(-bound, bound, (fi, fo)))
        params.append(rng.uniform(-bound, bound, fo))
    return params


def flatten(params) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params])


def unflatten(vec: np.ndarray, sizes) -> list[np.ndarray]:
    out, o = [], 0
    for fi, fo in zip(sizes[:-1], sizes[1:]):
        out.append(vec[o:o + fi * fo].reshape(fi, fo)); o += fi * fo
        out.append(vec[o:o + fo].copy()); o += fo
    return out


def forward(X: np.ndarray, params) -> tuple[list, list]:
    acts, pre = [X], []
    n_layers = len(params) // 2
    a = X
    for i in range(n_layers):
        z = a @ params[2 * i] + params[2 * i + 1]
        pre.append(z)
        a = z if i == n_layers - 1 else np.maximum(z, 0.0)
        acts.append(a)
    return acts, pre


def reconstruction_error(X: np.ndarray, params) -> np.ndarray:
    acts, _ = forward(X, params)
    return np.mean((X - acts[-1]) ** 2, axis=1)


def loss_and_gradient(X: np.ndarray, params) -> tuple[float, np.ndarray]:
    """Summed squared reconstruction loss of the rows (halved, mean over outputs) and its gradient."""
    acts, pre = forward(X, params)
    delta = (acts[-1] - X) / X.shape[1]
    loss = 0.5 * float(np.sum((acts[-1] - X) ** 2)) / X.shape[1]
    grads = [None] * len(params)
    for i in range(len(params) // 2 - 1, -1, -1):
        grads[2 * i] = acts[i].T @ delta
        grads[2 * i + 1] = delta.sum(axis=0)
        if i > 0:
            delta = (delta @ params[2 * i].T) * (pre[i - 1] > 0)
    return loss, flatten(grads)


def minimise(evaluate, x: np.ndarray, iterations: int, memory: int = 10, tol: float = 1e-7) -> tuple[np.ndarray, bool]:
    """L-BFGS with backtracking; ``evaluate`` gives (loss, gradient). The point and whether the tolerance was reached."""
    f, g = evaluate(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        q, back = g.copy(), []
        for s, y in reversed(steps):
            a = (s @ q) / (s @ y)
            q -= a * y
            back.append(a)
        if steps:
            s, y = steps[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, float(np.linalg.norm(g)))
        for (s, y), a in zip(steps, reversed(back)):
            q += s * (a - (y @ q) / (s @ y))
        slope, t = float(g @ q), 1.0
        if slope <= 0:
            q, slope, steps = g.copy(), float(g @ g), []
        for _ in range(20):
            x2 = x - t * q
            f2, g2 = evaluate(x2)
            if f2 <= f - 1e-4 * t * slope:
                break
            t /= 2
        else:
            if not steps:
                return x, False     # no descent along the gradient either
            steps = []
            continue
        s, y = x2 - x, g2 - g
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-memory:]
        done = f - f2 <= tol * max(1.0, abs(f))
        x, f, g = x2, f2, g2
        if done:
            return x, True
    return x, False


def _objective(vec: np.ndarray, n: float, loss: float, grad: np.ndarray, weights: np.ndarray, alpha: float) -> tuple[float, np.ndarray]:
    l2 = alpha * vec * weights / n
    return loss / n + 0.5 * float(l2 @ vec), grad / n + l2


def _fit_rows(X: np.ndarray, sizes, start: np.ndarray, weights: np.ndarray, alpha: float, epochs: int) -> tuple[np.ndarray, bool]:
    X = X[np.lexsort(X.T)]      # sums do not depend on the order of rows
    return minimise(lambda v: _objective(v, max(len(X), 1.0), *loss_and_gradient(X, unflatten(v, sizes)), weights, alpha), start, epochs)


def fit(train: DataFrame, features: list[str], key: str = "ROTTA", hidden=K.AE_HIDDEN,
        epochs: int = K.AE_MAX_EPOCHS, seed: int = K.RANDOM_STATE, alpha: float = 1e-4, rows_per_task: int = 50_000) -> np.ndarray:
    """Trained parameter vector (broadcast-sized: a few hundred doubles) after at most ``epochs`` full-batch steps."""
    spark = train.sparkSession
    sizes = [len(features), *hidden, len(features)]
    weights = np.concatenate([np.r_[np.ones(a * b), np.zeros(b)] for a, b in zip(sizes[:-1], sizes[1:])])
    start, tasks = flatten(init_params(sizes, seed)), max(1, math.ceil(train.count() / rows_per_task))

    def objective(vec: np.ndarray, n: float, loss: float, grad: np.ndarray) -> tuple[float, np.ndarray]:
        return _objective(vec, n, loss, grad, weights, alpha)

    def trained(vec: np.ndarray, converged: bool) -> np.ndarray:
        if not converged:
            warnings.warn(f"autoencoder: tolerance not reached within {epochs} steps", RuntimeWarning, stacklevel=3)
        return vec

    if tasks == 1:
        def whole(batches):
            X = np.concatenate([np.zeros((0, len(features))), *[b.to_numpy(dtype=float) for b in batches]])
            vec, ok = _fit_rows(X, sizes, start, weights, alpha, epochs)
            yield pd.DataFrame({"i": np.arange(-1, len(vec)), "x": np.concatenate([[ok], vec])})

        found = {r["i"]: r["x"] for r in train.select(*features).repartition(1).mapInPandas(whole, "i int, x double").collect()}
        return trained(np.array([found[i] for i in range(len(start))]), found[-1] == 1)
    m = len(features)

    def packed(batches):
        for b in batches:
            X = b.to_numpy(dtype=float)
            yield pd.DataFrame({"x": [np.ascontiguousarray(X[i:i + BLOCK]).tobytes() for i in range(0, len(X), BLOCK)]})

    data = train.select(*features).repartition(tasks).mapInPandas(packed, "x binary").rdd.map(lambda r: bytes(r["x"])) \
        .persist(StorageLevel.MEMORY_AND_DISK)

    def evaluate(vec: np.ndarray) -> tuple[float, np.ndarray]:
        def run(blocks):
            params, n, loss, grad = unflatten(vec, sizes), 0, 0.0, np.zeros(len(vec))
            for x in blocks:
                X = np.frombuffer(x).reshape(-1, m)
                one, g = loss_and_gradient(X, params)
                n, loss, grad = n + len(X), loss + one, grad + g
            yield np.concatenate([[n, loss], grad])

        sums = np.sum(data.mapPartitions(run).collect(), axis=0)        # a vector a partition, in their order
        return objective(vec, max(sums[0], 1.0), sums[1], sums[2:])

    try:
        return trained(*minimise(evaluate, start, epochs))
    finally:
        data.unpersist()


def score(df: DataFrame, features: list[str], vec: np.ndarray, key: str = "ROTTA", hidden=K.AE_HIDDEN,
          out: str = "ae_error") -> DataFrame:
    sizes = [len(features), *hidden, len(features)]
    bc = df.sparkSession.sparkContext.broadcast(vec)

    def run(batches):
        params = unflatten(bc.value, sizes)
        for b in batches:
            X = b[features].to_numpy(dtype=float)
            yield pd.DataFrame({key: b[key], out: reconstruction_error(X, params)})

    schema = T.StructType([df.schema[key], T.StructField(out, T.DoubleType())])
    return df.select(key, *features).mapInPandas(run, schema)


def autoencoder_scores(scaled: DataFrame, features: list[str], key: str = "ROTTA", normal_col: str = "if_normal",
                       seed: int = K.RANDOM_STATE, epochs: int | None = None,
                       min_samples: int = K.AE_MIN_SAMPLES) -> DataFrame | None:
    """(key, score_ae) min-max normalised, or None when too few normal rows."""
    from lanewatch.operators.detectors.ensemble import minmax
    normal = scaled.filter(F.col(normal_col))
    if normal.count() < min_samples:
        return None
    vec = fit(normal, features, key=key, epochs=epochs or K.AE_MAX_EPOCHS, seed=seed)
    from lanewatch.session import keep
    err = keep(score(scaled, features, vec, key=key))  # read by the min/max and the projection
    return minmax(err, {"score_ae": "ae_error"}).select(key, "score_ae")


def autoencoder_scores_by(scaled: DataFrame, features: list[str], group_col: str, key: str = "ROTTA", normal_col: str = "if_normal",
                          seed: int = K.RANDOM_STATE, epochs: int | None = None, min_samples: int = K.AE_MIN_SAMPLES,
                          alpha: float = 1e-4, rows_per_task: int = 50_000) -> DataFrame:
    """(group, key, score_ae): one autoencoder per group; null where a group has too few normal rows.

    Groups of at most ``rows_per_task`` rows are fitted side by side, one task each; a larger one by ``autoencoder_scores``.
    """
    from lanewatch.operators.detectors.ensemble import minmax
    from lanewatch.session import keep
    sizes, epochs = [len(features), *K.AE_HIDDEN, len(features)], epochs or K.AE_MAX_EPOCHS
    weights = np.concatenate([np.r_[np.ones(a * b), np.zeros(b)] for a, b in zip(sizes[:-1], sizes[1:])])
    start = flatten(init_params(sizes, seed))
    counts = scaled.groupBy(group_col).agg(F.count(F.lit(1)).alias("n"))
    large = [r[group_col] for r in counts.filter(F.col("n") > rows_per_task).collect()]      # a short list of groups
    schema = T.StructType([scaled.schema[group_col], scaled.schema[key], T.StructField("ae_error", T.DoubleType())])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        normal = pdf.loc[pdf[normal_col].to_numpy(dtype=bool), features].to_numpy(dtype=float)
        out = pdf[[group_col, key]].copy()
        out["ae_error"] = np.nan
        if len(normal) >= min_samples:
            vec, ok = _fit_rows(normal, sizes, start, weights, alpha, epochs)
            if not ok:
                warnings.warn(f"autoencoder: tolerance not reached within {epochs} steps", RuntimeWarning, stacklevel=1)
            out["ae_error"] = reconstruction_error(pdf[features].to_numpy(dtype=float), unflatten(vec, sizes))
        return out

    small = scaled.filter(~F.col(group_col).isin(large)) if large else scaled
    err = keep(small.select(group_col, key, normal_col, *features).groupBy(group_col).applyInPandas(one, schema)
               .withColumn("ae_error", F.nanvl("ae_error", F.lit(None).cast("double"))))
    out = minmax(err, {"score_ae": "ae_error"}, by=(group_col,)) \
        .withColumn("score_ae", F.when(F.col("ae_error").isNotNull(), F.col("score_ae"))).select(group_col, key, "score_ae")
    for g in large:
        own = autoencoder_scores(scaled.filter(F.col(group_col) == g), features, key, normal_col, seed, epochs, min_samples)
        if own is not None:
            out = out.unionByName(own.select(F.lit(g).cast(scaled.schema[group_col].dataType).alias(group_col), key, "score_ae"))
    return out
