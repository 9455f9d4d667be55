"""Isolation forest on Spark, grown level by level in DataFrame operations.

Training sample: every row has two md5 numbers a, b of (key, seed); its place in a tree's
lottery is (a + tree * b) mod a prime. A tree's sample is its ``psi`` rows with the smallest
places. Rows are pre-filtered with place < p (p ~ 3*psi/n) inside one projection, so only
~3*psi candidates per tree are shuffled; the choice does not depend on partitioning.

Training: one window per level over (tree, node) gives the count and every feature's least
and largest value; an md5 draw of (tree, node, seed) picks one of the features that
vary, another the threshold between its ends. Rows are dealt by tree once, all levels run on that
partitioning, and every node has one row in the result (children of node i are 2 i + 1
and 2 i + 2). All of it is SQL-expressible. The forest has at most n_trees * (2*psi - 1)
nodes — bounded by the parameters, never by the data — so it is broadcast for
scoring, which is a vectorised ``mapInPandas`` pass.

Scores follow the usual definition s(x) = 2^(-E[h(x)] / c(psi)), where h is the
leaf depth plus c(leaf size).  Not bit-identical to other implementations
(different random streams), same estimator.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewatch.operators.quantiles import quantiles, quantiles_by

EULER = 0.5772156649015329
#: lottery places are numbers below this prime
PLACES = 4294967291


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search over n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _md5_number(text: Column, at: int) -> Column:
    """Eight hex digits of an md5 as a number."""
    return F.conv(F.substring(F.md5(text), at, 8), 16, 10).cast("bigint")


def samples(scaled: DataFrame, features: list[str], key: str, n_trees: int, max_samples: int, seed: int,
            groups: list[str], own_draws: bool = True) -> DataFrame:
    """(group..., tree_id, key, x, psi): the rows that each tree is grown on."""
    size = F.least(F.lit(max_samples), F.col("n")).cast("int")
    if groups:      # every group has its own sample size and candidate share
        sizes = scaled.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).select(*groups, size.alias("psi"), "n")
        sized = scaled.join(sizes, groups)
    else:
        sized = scaled.withColumn("n", F.lit(scaled.count())).withColumn("psi", size)
    text = F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)), *[F.col(g).cast("string") for g in groups if own_draws])
    x = F.array(*[F.col(c).cast("double") for c in features])
    drawn = sized.select(*groups, F.col(key), x.alias("x"), "psi", "n", text.alias("_t")).select(
        *groups, key, "x", "psi", "n", _md5_number(F.col("_t"), 1).alias("a"), _md5_number(F.col("_t"), 9).alias("b"))
    share = F.lit(3.0 * PLACES) * F.col("psi") / F.col("n")     # about 3 psi candidates a tree, the psi first are its sample
    trees = F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.struct(
        t.alias("tree_id"), F.pmod(F.col("a") + t * F.col("b"), F.lit(PLACES)).alias("place")))
    candidates = drawn.select(*groups, key, "x", "psi", F.explode(F.filter(trees, lambda s: s["place"] < share)).alias("s"))
    order = Window.partitionBy(*groups, "tree_id").orderBy("place", key)
    # one shuffle by tree for this window and all levels; not coalesced, since the levels are work, not bytes
    tasks = int(scaled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (candidates.select(*groups, "s.tree_id", "s.place", key, "x", "psi").repartition(tasks, *groups, "tree_id")
            .withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= F.col("psi")).drop("_n", "place"))


def fit(scaled: DataFrame, features: list[str], key: str = "ROTTA", n_trees: int = 200,
        max_samples: int = 256, seed: int = 42, group_col: str | None = None, own_draws: bool = True) -> DataFrame:
    """Node table of an isolation forest.

    ``group_col`` (optional) trains one forest per value of that column — used
    by refit studies and perimeter sweeps. ``own_draws=False``: every group draws what
    a run on that group alone would draw.
    """
    groups = [group_col] if group_col else []
    tree = [*groups, "tree_id"]
    rows = samples(scaled, features, key, n_trees, max_samples, seed, groups, own_draws).withColumnRenamed(key, "_key").selectExpr(
        *tree, "_key", "x", "psi", "0 AS node", "cast(ceil(log2(cast(greatest(psi, 2) AS double))) AS int) AS top",
        "cast(array() AS array<struct<node:int,feature:int,threshold:double,leaf_value:double,n:int>>) AS made")
    m, carried, ids = len(features), [*tree, "_key", "x", "psi", "top"], ", ".join(tree)
    over = f"OVER (PARTITION BY {ids}, node)"
    lo, hi = (", ".join(f"{f}(x[{j}]) {over}" for j in range(m)) for f in ("min", "max"))
    who = ", ".join(f"cast({c} AS string)" for c in (*(tree if own_draws else ["tree_id"]), "node"))

    def draw(what: str) -> str:
        """U(0, 1), ends excluded, from md5 of the '|'-joined parts."""
        return f"((cast(conv(substring(md5(concat_ws('|', {who}, '{seed}', '{what}')), 1, 8), 16, 10) AS bigint) + 0.5D) / 4294967296.0D)"

    # SQL text: a level's hundred expressions are one call
    for level in range(math.ceil(math.log2(max(max_samples, 2))) + 1):
        seen = rows.selectExpr("*", f"cast(count(1) {over} AS int) AS n", f"min(_key) {over} AS one", f"array({lo}) AS lo", f"array({hi}) AS hi")
        seen = seen.selectExpr("*", f"CASE WHEN n > 1 AND {level} < top AND node >= 0 THEN filter(sequence(0, {m - 1}), j -> hi[j] > lo[j]) "
                                    "ELSE cast(array() AS array<int>) END AS vary")
        seen = seen.selectExpr("*", f"CASE WHEN size(vary) > 0 THEN vary[cast(floor({draw('feature')} * size(vary)) AS int)] ELSE -1 END AS feature")
        seen = seen.selectExpr("*", f"CASE WHEN feature >= 0 THEN lo[feature] + {draw('threshold')} * (hi[feature] - lo[feature]) END AS cut")
        # both sides have rows
        seen = seen.selectExpr("*", "CASE WHEN feature >= 0 THEN CASE WHEN cut > lo[feature] THEN cut ELSE hi[feature] END END AS threshold")
        leaf = (f"CASE WHEN feature >= 0 THEN 0.0D WHEN n > 2 THEN {level} + 2.0D * (ln(n - 1.0D) + {EULER!r}D) - 2.0D * (n - 1.0D) / n "
                f"WHEN n = 2 THEN {level} + 1.0D ELSE {level} + 0.0D END")
        rows = seen.selectExpr(
            *carried, "CASE WHEN feature >= 0 THEN 2 * node + CASE WHEN x[feature] < threshold THEN 1 ELSE 2 END ELSE -1 END AS node",
            "CASE WHEN node >= 0 AND _key = one THEN concat(made, array(struct(node, feature, coalesce(threshold, 0.0D) AS threshold, "
            f"{leaf} AS leaf_value, n))) ELSE made END AS made")
    nodes = rows.select(*tree, "psi", F.explode("made").alias("s"))
    nodes = nodes.select(*groups, "tree_id", "s.node", "s.feature", "s.threshold",
                        F.when(F.col("s.feature") >= 0, 2 * F.col("s.node") + 1).otherwise(-1).alias("left"),
                        F.when(F.col("s.feature") >= 0, 2 * F.col("s.node") + 2).otherwise(-1).alias("right"),
                        F.col("s.leaf_value").alias("leaf_value"), "psi",
                        F.max(F.when(F.col("s.node") == 0, F.col("s.n"))).over(Window.partitionBy(*tree)).alias("n_sampled"))
    return nodes.toDF(*nodes.columns)       # columns of its own, so that it can meet the rows it came from


def _pack(nodes_pdf: pd.DataFrame):
    """Node table -> dense (trees x max_nodes) arrays for vectorised traversal."""
    trees = np.sort(nodes_pdf["tree_id"].unique())
    m = int(nodes_pdf["node"].max()) + 1
    shape = (len(trees), m)
    feat = np.full(shape, -1, dtype=np.int64)
    thr = np.zeros(shape)
    left = np.zeros(shape, dtype=np.int64)
    right = np.zeros(shape, dtype=np.int64)
    val = np.zeros(shape)
    ti = np.searchsorted(trees, nodes_pdf["tree_id"].to_numpy())
    ni = nodes_pdf["node"].to_numpy()
    feat[ti, ni] = nodes_pdf["feature"].to_numpy()
    thr[ti, ni] = nodes_pdf["threshold"].to_numpy()
    left[ti, ni] = nodes_pdf["left"].to_numpy()
    right[ti, ni] = nodes_pdf["right"].to_numpy()
    val[ti, ni] = nodes_pdf["leaf_value"].to_numpy()
    return feat, thr, left, right, val


def path_lengths(X: np.ndarray, packed) -> np.ndarray:
    """Mean path length of each row over the forest."""
    feat, thr, left, right, val = packed
    n = X.shape[0]
    total = np.zeros(n)
    rows = np.arange(n)
    for t in range(feat.shape[0]):
        node = np.zeros(n, dtype=np.int64)
        while True:
            f = feat[t, node]
            inner = f >= 0
            if not inner.any():
                break
            xv = X[rows, np.where(inner, f, 0)]
            nxt = np.where(xv < thr[t, node], left[t, node], right[t, node])
            node = np.where(inner, nxt, node)
        total += val[t, node]
    return total / feat.shape[0]


def score(scaled: DataFrame, nodes: DataFrame, features: list[str], key: str = "ROTTA",
          out: str = "if_score", keep=()) -> DataFrame:
    """Anomaly score s in (0, 1] per row (higher = more isolated); ``keep`` columns pass through."""
    spark = scaled.sparkSession
    pdf = nodes.toPandas()  # bounded: n_trees * (2*psi - 1) rows
    psi = int(pdf["psi"].iloc[0])
    bc = spark.sparkContext.broadcast(_pack(pdf))
    cpsi = float(c_factor([psi])[0]) or 1.0

    def run(batches):
        packed = bc.value
        for b in batches:
            X = b[features].to_numpy(dtype=float)
            h = path_lengths(X, packed)
            res = b[list(keep) + [key]].copy()
            res[out] = np.power(2.0, -h / cpsi)
            yield res

    schema = T.StructType([scaled.schema[c] for c in keep] + [scaled.schema[key], T.StructField(out, T.DoubleType())])
    return scaled.select(*keep, key, *features).mapInPandas(run, schema)


def score_by(scaled: DataFrame, nodes: DataFrame, features: list[str], group_col: str, key: str = "ROTTA",
             out: str = "if_score") -> DataFrame:
    """``score`` with the forest of each row's group; the forests of a short list of groups are broadcast together."""
    spark = scaled.sparkSession
    pdf = nodes.toPandas()          # bounded: groups x n_trees x (2*psi - 1) rows
    forests = {g: (_pack(own), float(c_factor([int(own["psi"].iloc[0])])[0]) or 1.0) for g, own in pdf.groupby(group_col)}
    bc = spark.sparkContext.broadcast(forests)

    def run(batches):
        for b in batches:
            res = b[[group_col, key]].copy()
            s = np.zeros(len(b))
            for g, (packed, c) in bc.value.items():
                own = (b[group_col] == g).to_numpy()
                if own.any():
                    s[own] = np.power(2.0, -path_lengths(b.loc[own, features].to_numpy(dtype=float), packed) / c)
            res[out] = s
            yield res

    schema = T.StructType([scaled.schema[group_col], scaled.schema[key], T.StructField(out, T.DoubleType())])
    return scaled.select(group_col, key, *features).mapInPandas(run, schema)


def with_prediction(scores: DataFrame, contamination: float, col: str = "if_score",
                    out: str = "if_normal", by: tuple[str, ...] = ()) -> DataFrame:
    """Inlier flag: score at or below its (1 - contamination) quantile, in the table or the row's group."""
    if by:
        t = quantiles_by(scores, {"t": col}, [1.0 - contamination], by).select(*by, F.col("q")[0].alias("_t"))
        return scores.join(t, list(by)).withColumn(out, F.col(col) <= F.col("_t")).drop("_t")
    t = quantiles(scores, {"t": col}, [1.0 - contamination])["t"][0]
    return scores.withColumn(out, F.col(col) <= F.lit(t).cast("double"))
