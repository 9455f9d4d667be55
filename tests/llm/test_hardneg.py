"""Hard negatives against all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lanewatch.llm import hardneg as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, positives=5, negatives=3):
    kept = []
    for rid, (i, v, label) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own = (label + 1) % 10 if i % 7 == 0 else label
        kept.append((rid, i, own, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for rid, i, label, v in kept:
        if i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, r, other == label) for r, j, other, w in kept if r != rid]
        scored.sort()
        for p, j, _, _ in [s for s in scored if s[3]][:positives]:
            inside = [s for s in scored if not s[3] and 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives]
            out += [(i, j, n, s[1], -p, -s[0]) for n, s in enumerate(inside, 1)]
    return sorted(out)


def vectors(seed, n=700, dim=12, clusters=None, spread=1.0, labels=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters or 1, dim))
    rows = []
    for i in range(n):
        c = int(rng.integers(clusters)) if clusters else 0
        v = (middle[c] if clusters else 0) + spread * rng.normal(size=dim)
        rows.append((i, [float(x) for x in v / np.linalg.norm(v)], int(c % labels if clusters else rng.integers(labels))))
    return rows


def result(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for c in ("rid", "id", "v", "score", "anchor", "part", "n", "rank", "bundle"):
        df = df.withColumn(c, F.lit("own"))
    return sorted(tuple(r) for r in H.mine(df, **options).collect())


def test_all_scores(spark):
    rows = vectors(1)
    want = expected(rows)
    assert want and result(spark, rows) == want


def test_bundles_blocks_and_small_trees(spark):
    """Several bundles, trees and blocks give the same rows."""
    rows = vectors(2, n=1500, clusters=6, spread=0.3)
    assert result(spark, rows, tree=5, bundle=12, block_bytes=1, block_rows=100) == expected(rows)


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = vectors(3, n=320, dim=6, labels=2)
    same = [0.5, 0.25, 0.0, 0.0, 0.125, 0.0]
    rows += [(1000 + i, same, i % 2) for i in range(40)]                               # ties
    rows += [(2050, same, 1)] * 3 + [(2051, same, 0)] * 4                              # repeated rows, one an anchor
    rows += [(None, same, 1), (3000, None, 1), (3050, same, None), (3100, [0.1, None] + same[2:], 1),
             (3150, [float("nan")] * 6, 1), (3200, [float("inf")] + same[1:], 1), (3300, [0.0] * 6, 1), (3350, [], 0),
             (3400, same[:3], 1), (-50, [-x for x in same], 1), (-7, same, 9), (3500, [30000.0] * 6, 0)]
    rng.shuffle(rows)
    def padded(v):
        return v if v is None else list(v) + [0.0] * (6 - len(v))
    assert result(spark, rows) == expected([(i, padded(v), label) for i, v, label in rows])


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.5], 3)], [(50, [0.5, 0.5], 3)], [(0, [0.5], 1), (1, [0.4], 2)]])
def test_few_rows(spark, rows):
    assert result(spark, rows) == expected(rows)


def _parts(rows, label, same):
    points = np.array([[math.floor(256 * x) for x in v] for _, v, _ in rows], dtype=np.int64)
    ids = np.arange(len(rows))
    return H.Block(ids, ids, np.array([r[2] for r in rows]), points).part(label, same)


def _tree(part, every):
    at = np.flatnonzero(part.ids % every == 0)
    order, parents = H.spanning_tree(part.points[at])
    return H.Tree(0, part.rids[at][order], part.ids[at][order], parents, part.points[at][order])


def test_tree():
    points = np.random.default_rng(4).integers(-50, 50, size=(60, 5))
    order, parents = H.spanning_tree(points)
    assert sorted(order) == list(range(60)) and parents[0] == -1 and all(p < k for k, p in enumerate(parents) if k)
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    total = sum(d[order[k], order[p]] for k, p in enumerate(parents) if k)
    reached, want = {0}, 0.0
    while len(reached) < 60:
        w, v = min((d[a, b], b) for a in reached for b in range(60) if b not in reached)
        want += w
        reached.add(v)
    assert math.isclose(total, want)


def test_bounds_save_scores():
    """With close anchors most candidates are ruled out unscored; the bounds hold for all of them."""
    rows = vectors(5, n=3000, dim=16, clusters=5, spread=0.05)
    same, other = _parts(rows, 0, True), _parts(rows, 0, False)
    tree = _tree(same, 3)
    scored = 0

    def near(a, lo, hi):
        true = other.points @ tree.points[a]
        assert (lo <= true).all() and (true <= hi).all()
        return (hi >= 30_000) & (lo <= 62_000)

    for a, found, scores in H.walk(tree, other, near):
        scored += len(found)
        assert (scores == other.points[found] @ tree.points[a]).all()
        true = other.points @ tree.points[a]
        assert set(np.flatnonzero((true >= 30_000) & (true <= 62_000))) <= set(found)
    assert scored < 0.5 * len(tree.ids) * len(other.ids)
