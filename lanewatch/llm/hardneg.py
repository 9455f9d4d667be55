"""Hard-negative mining with spanning-tree bounds on the anchors.

Anchors (every ``anchor_every``-th id) of one label form groups of at most about
``tree`` anchors; each group's minimum spanning tree (Prim) is grown in a task. A block of
candidates is scored against a tree from its root: the root's scores are exact; a
child's score lies within its parent's plus or minus edge length times the candidate's
norm (Cauchy-Schwarz on the difference of the two anchors). Only candidates whose bounds
reach the child's window are rescored: for positives, rows of the anchor's label that can be
among its best; for negatives, rows of other labels that can lie between the windows' ends.
What is rescored is exact again for the child's children; the others' bounds widen. So the
result is exact whatever the vectors are like; close anchors save work, unrelated ones none.

Plan: rows become integer vectors once (checkpoint). Trees of at most ``bundle`` anchors at
a time are broadcast, a bounded number of bytes; every partition scores its rows in
blocks against them and emits only the best few of each anchor. Two passes a bundle:
positives, then, with their scores known, negatives. The final ranks are windows per
(anchor, positive) over what the blocks emitted.

Defined results: rows with a null id or label, a null vector or a null or non-finite component take no
part; a shorter vector counts as padded with zeros; repeated rows are rows of their
own (an anchor's twin is another row); equal scores of equal ids are in any fixed order; a
negative positive score has no window; no rows or no anchors give no rows; other columns
are not read. A hundred times a score must fit a long; where doubles hold
scores exactly they are used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanewatch.llm.common import kept, read, register

TREE = "label long, n int, dim int, rids binary, ids binary, parents binary, vectors binary"
FOUND = "anchor long, rid long, id long, score long"


def vectors(rows: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = 256,
            relabel_every: int | None = 7, labels: int = 10) -> DataFrame:
    """rid, id, label, v (floor(scale * component)) of the rows that take part; ``rid`` tells repeated rows apart."""
    x = F.col(embedding)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    own = F.col(label).cast("long")
    if relabel_every:
        own = F.when(F.col(vec_id) % relabel_every == 0, (own + 1) % labels).otherwise(own)
    return rows.filter(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.monotonically_increasing_id().alias("rid"), F.col(vec_id).cast("long").alias("id"), own.alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))


# ---- trees

@dataclass
class Tree:
    """Anchors of one label, parents before children; the root's parent is -1."""

    label: int
    rids: np.ndarray
    ids: np.ndarray
    parents: np.ndarray
    points: np.ndarray

    def __post_init__(self) -> None:
        diff = self.points - self.points[np.maximum(self.parents, 0)]
        self.edges = np.sqrt((diff.astype(np.float64) ** 2).sum(axis=1))
        self.norms = np.sqrt((self.points.astype(np.float64) ** 2).sum(axis=1))
        self.children = np.bincount(self.parents[self.parents >= 0], minlength=len(self.parents))


def matrix(col: pa.Array, dim: int | None = None) -> np.ndarray:
    """Lists of longs as rows, shorter ones padded with zeros."""
    off = col.offsets.to_numpy().astype(np.int64)
    flat = col.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]]
    lens = np.diff(off)
    width = max(int(lens.max(initial=0)), dim or 0)
    if len(lens) and (lens == width).all():
        return flat.reshape(len(lens), width)
    out = np.zeros((len(lens), width), dtype=np.int64)
    at = np.arange(lens.sum()) - np.repeat(off[:-1] - off[0], lens)
    out[np.repeat(np.arange(len(lens)), lens), at] = flat
    return out


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order (parents first, the larger subtree of a node last) and parents (in that order) of a minimum spanning tree."""
    n, x = len(points), points.astype(np.float64)
    square = (x * x).sum(axis=1)
    parent, near = np.full(n, -1), np.full(n, np.inf)
    out, at, joined = np.zeros(n, dtype=bool), 0, []
    for _ in range(n):
        out[at] = True
        joined.append(at)
        d = square + square[at] - 2 * (x @ x[at])
        closer = (d < near) & ~out
        near[closer], parent[closer] = d[closer], at
        if len(joined) < n:
            at = int(np.where(out, np.inf, near).argmin())
    size = np.ones(n, dtype=np.int64)
    kids: list[list[int]] = [[] for _ in range(n)]
    for v in reversed(joined):
        if parent[v] >= 0:
            size[parent[v]] += size[v]
            kids[parent[v]].append(v)
    order, stack = [], joined[:1]
    while stack:
        v = stack.pop()
        order.append(v)
        stack += sorted(kids[v], key=lambda c: (-size[c], c))      # popped smallest first
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    return np.array(order, dtype=np.int64), np.array([place[parent[v]] if parent[v] >= 0 else -1 for v in order], dtype=np.int64)


def trees(anchors: DataFrame, size: int = 1024) -> DataFrame:
    """TREE rows: the anchors of every label, in hashed groups of about ``size``."""
    counts = anchors.groupBy("label").agg(F.ceil(F.count("*") / size).alias("parts"))
    grouped = anchors.join(counts, "label").withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts")))

    def grow(table: pa.Table) -> pa.Table:
        table = table.sort_by("rid").combine_chunks()
        points = matrix(table.column("v").chunk(0) if table.column("v").num_chunks else table.column("v").combine_chunks())
        order, parents = spanning_tree(points)
        cols = [np.ascontiguousarray(a, dtype="<i8").tobytes() for a in (
            table.column("rid").to_numpy()[order], table.column("id").to_numpy()[order], parents, points[order])]
        return pa.table([pa.array([table.column("label")[0].as_py()], pa.int64()), pa.array([len(order)], pa.int32()),
                         pa.array([points.shape[1]], pa.int32()), *[pa.array([c], pa.binary()) for c in cols]],
                        ["label", "n", "dim", "rids", "ids", "parents", "vectors"])

    return grouped.groupBy("label", "part").applyInArrow(grow, TREE)


def unpack(row) -> Tree:
    rids, ids, parents, points = (np.frombuffer(row[c], dtype="<i8") for c in ("rids", "ids", "parents", "vectors"))
    return Tree(row["label"], rids, ids, parents, points.reshape(row["n"], row["dim"]))


# ---- blocks against trees

class Block:
    """Candidate rows in order of label."""

    def __init__(self, rids: np.ndarray, ids: np.ndarray, labels: np.ndarray, points: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.rids, self.ids, self.labels, self.points = rids[order], ids[order], labels[order], points[order]

    def part(self, label: int, same: bool) -> Part:
        a, b = np.searchsorted(self.labels, [label, label + 1])
        rows = np.arange(a, b) if same else np.r_[0:a, b:len(self.labels)]
        return Part(self.rids[rows], self.ids[rows], self.points[rows])


class Part:
    def __init__(self, rids: np.ndarray, ids: np.ndarray, points: np.ndarray):
        self.rids, self.ids, self.points = rids, ids, points
        self.norms = np.sqrt((points.astype(np.float64) ** 2).sum(axis=1))


def walk(tree: Tree, part: Part, wanted: Callable) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, their exact scores) down the tree; ``wanted(anchor, lo, hi)`` masks the rows that its bounds cannot rule out."""
    width = max(tree.points.shape[1], part.points.shape[1])
    x, c = (np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in (part.points, tree.points))
    both = max(float(np.abs(x).max(initial=0)), 1) * max(float(np.abs(c).max(initial=0)), 1) * max(width, 1)
    if both < 2 ** 53:
        x, c = x.astype(np.float64), c.astype(np.float64)
    held: dict[int, list] = {}
    for a in range(len(c)):
        p = int(tree.parents[a])
        if p < 0:
            lo = hi = (x @ c[a]).astype(np.float64)
            rows, scores = np.arange(len(x)), x @ c[a]
        else:
            # a little more than the bound, for rounding
            reach = part.norms * (tree.edges[a] * (1 + 1e-9) + tree.norms[a] * 1e-12) + 1e-6
            lo, hi = held[p][0] - reach, held[p][1] + reach
            rows = np.flatnonzero(wanted(a, lo, hi))
            if 2 * len(rows) > len(x):
                scores = (x @ c[a])[rows]
            else:
                scores = x[rows] @ c[a]
            lo[rows] = hi[rows] = scores
            held[p][2] -= 1
            if not held[p][2]:
                del held[p]
        if tree.children[a]:
            held[a] = [lo, hi, int(tree.children[a])]
        yield a, rows, scores.astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, by score (descending) and id."""
    at = np.arange(len(scores))
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def positives_in(tree: Tree, part: Part, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, scores): the k best rows of the part for every anchor, itself left out."""
    own = {int(r): i for i, r in enumerate(part.rids)}

    def wanted(a: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        sure = lo
        if (i := own.get(int(tree.rids[a]))) is not None:
            sure = np.delete(lo, i)
        if len(sure) <= k:
            return np.ones(len(lo), dtype=bool)
        return hi >= np.partition(sure, len(sure) - k)[len(sure) - k]

    for a, rows, scores in walk(tree, part, wanted):
        other = part.rids[rows] != tree.rids[a]
        rows, scores = rows[other], scores[other]
        top = best(scores, part.ids[rows], k)
        yield a, rows[top], scores[top]


def windows(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest integer score s with low * p <= 100 * s <= high * p."""
    return -((-low * scores) // 100), (high * scores) // 100


def negatives_in(tree: Tree, part: Part, found: dict[int, np.ndarray], k: int, low: int, high: int):
    """(anchor, rows, scores): the k best rows of the part in every window of an anchor's positive scores."""
    bounds = {}
    for a, rid in enumerate(tree.rids):
        least, most = windows(found.get(int(rid), np.zeros(0, dtype=np.int64)), low, high)
        bounds[a] = least[least <= most], most[least <= most]

    def wanted(a: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        least, most = bounds[a]
        if not len(least):
            return np.zeros(len(lo), dtype=bool)
        return (hi >= least.min()) & (lo <= most.max())

    for a, rows, scores in walk(tree, part, wanted):
        picks = set()
        for least, most in zip(*bounds[a], strict=True):
            at = np.flatnonzero((scores >= least) & (scores <= most))
            picks.update(at[best(scores[at], part.ids[rows[at]], k)].tolist())
        at = np.array(sorted(picks), dtype=np.int64)
        yield a, rows[at], scores[at]


def _scan(rows: DataFrame, held, same: bool, find: Callable, block_bytes: int) -> DataFrame:
    """FOUND rows of every block of candidates against every tree of a broadcast bundle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, scores = held.value
        grown = [unpack(t) for t in packed]
        waiting, size = [], 0

        def solve() -> Iterator[pa.RecordBatch]:
            width = max(p.shape[1] for _, _, _, p in waiting)
            points = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for _, _, _, p in waiting])
            block = Block(*[np.concatenate([w[i] for w in waiting]) for i in range(3)], points)
            waiting.clear()
            parts: dict[int, Part] = {}
            for tree in grown:
                if tree.label not in parts:
                    parts.clear()                       # trees come in order of label: one part at a time
                    parts[tree.label] = block.part(tree.label, same)
                part = parts[tree.label]
                if not len(part.rids):
                    continue
                out = [(int(tree.rids[a]), part.rids[r], part.ids[r], s) for a, r, s in find(tree, part, scores) if len(r)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([o[0] for o in out], [len(o[1]) for o in out]), pa.int64()),
                         *[pa.array(np.concatenate([o[i] for o in out]), pa.int64()) for i in (1, 2, 3)]],
                        ["anchor", "rid", "id", "score"])

        for batch in batches:
            if batch.num_rows:
                points = matrix(batch.column("v"))
                waiting.append([*[batch.column(c).to_numpy() for c in ("rid", "id", "label")], points])
                size += points.nbytes
                if size >= block_bytes:
                    yield from solve()
                    size = 0
        if waiting:
            yield from solve()

    return rows.mapInArrow(run, FOUND)


def _best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every anchor, numbered from 1."""
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "rid")
    return found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)


def mine(rows: DataFrame, *, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, anchor_every: int = 50,
         tree: int = 1024, bundle: int = 65_536, block_bytes: int = 32 << 20, block_rows: int = 16_384, **columns) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hard negatives of every anchor and positive.

    ``columns`` go to ``vectors``. At most ``bundle`` anchors (their vectors, some 64 MB at 64 components) are broadcast at a time.
    """
    spark = rows.sparkSession
    table = kept(vectors(rows, **columns))
    n = table.count()
    parts = max(1, min(-(-n // 1000), max(spark.sparkContext.defaultParallelism, -(-n // block_rows))))
    table = kept(table.repartition(parts))
    anchors = table.filter(F.col("id") % anchor_every == 0)
    grown = kept(trees(anchors, tree))
    sizes = grown.select("label", F.col("n"), F.xxhash64("rids").alias("t"))
    # trees in order of label, cut into bundles by running count: one row a tree
    in_order = Window.orderBy("label", "t").rowsBetween(Window.unboundedPreceding, -1)
    numbered = kept(sizes.withColumn("bundle", F.floor(F.coalesce(F.sum("n").over(in_order), F.lit(0)) / bundle).cast("int")))
    names = anchors.select(F.col("rid").alias("anchor"), F.col("id").alias("anchor_id"))
    out = None
    for b in range((numbered.agg(F.max("bundle")).first()[0] or 0) + 1):
        own = grown.withColumn("t", F.xxhash64("rids")).join(numbered.filter(F.col("bundle") == b).select("label", "t"), ["label", "t"])
        packed = sorted((r.asDict() for r in own.drop("t").collect()), key=lambda r: (r["label"], bytes(r["rids"])))
        if not packed:
            continue
        packed = [{k: bytes(v) if isinstance(v, bytearray) else v for k, v in r.items()} for r in packed]
        held = spark.sparkContext.broadcast((packed, None))
        first = _scan(table, held, True, lambda t, p, _: positives_in(t, p, positives), block_bytes)
        top = kept(_best_of(first, positives).select("anchor", F.col("rid").alias("positive"), F.col("id").alias("positive_id"),
                                                     F.col("score").alias("positive_score")))
        scores: dict[int, list[int]] = {}
        for r in top.select("anchor", "positive_score").toLocalIterator():        # at most ``positives`` an anchor of the bundle
            scores.setdefault(r[0], []).append(r[1])
        held.unpersist()
        held = spark.sparkContext.broadcast((packed, {a: np.array(s, dtype=np.int64) for a, s in scores.items()}))
        second = kept(_scan(table, held, False, lambda t, p, s: negatives_in(t, p, s, negatives, low, high), block_bytes))
        held.unpersist()
        fits = (F.col("score") * 100 >= F.col("positive_score") * low) & (F.col("score") * 100 <= F.col("positive_score") * high)
        order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id", "rid")
        ranked = top.join(second, "anchor").filter(fits).withColumn("rank", F.row_number().over(order)) \
            .filter(F.col("rank") <= negatives).select("anchor", "positive_id", "rank", F.col("id").alias("negative_id"),
                                                       "positive_score", F.col("score").alias("negative_score"))
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                                         "negative_score long")
    return out.join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@register("op12_hard_negatives", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(read(spark, sf_dir, "embeddings"))
