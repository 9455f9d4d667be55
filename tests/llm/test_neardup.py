"""Near duplicates against all pairs; sketches against their definition."""

import random

import numpy as np
import pytest

from lanewatch.llm.neardup import components, drop_near_duplicates, near_duplicates, similarity_sketch
from tests.llm.cases import SCHEMA, clashing, corpus, frame, plain_words, words


def _plain(docs, k, percent):
    sets = {}
    for d in docs:
        w = plain_words(d[1], lower=True)
        n = min(k, len(w))
        sets[d[0]] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


def _chain(rng):
    """Documents that link only along a chain, and two groups that share a bucket but no link."""
    base, out = words(rng, 200), []
    for i in range(12):
        base = list(base)
        for _ in range(2):
            base[rng.randrange(200)] = f"c{rng.randrange(10**6)}"
        out.append(" ".join(base))
    half = words(rng, 150)
    for tail in (words(rng, 70), words(rng, 75)):
        for i in range(4):
            x = half + tail
            x[rng.randrange(len(x))] = f"t{rng.randrange(10**6)}"
            out.append(" ".join(x))
    return out


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_against_all_pairs(spark, k, percent):
    docs = corpus()
    docs += [(len(docs) + i, t, None, None, len(t)) for i, t in enumerate(_chain(random.Random(9)))]
    want = _plain(docs, k, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in near_duplicates(clashing(frame(spark, docs)), shingle=k, percent=percent).collect()}
    assert got == want
    assert drop_near_duplicates(frame(spark, docs), shingle=k, percent=percent).count() == sum(x[2] for x in want.values())


def test_low_bands_give_many_candidates(spark):
    """With one star round the rest is settled by the join across components."""
    docs = [(i, t, None, None, len(t)) for i, t in enumerate(_chain(random.Random(11)))]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in near_duplicates(frame(spark, docs), bands=64, rows=2).collect()}
    assert got == _plain(docs, 3, 85)


def test_sketch_fills_every_bin_and_estimates():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 3, 50, 2000)]
    a, b = rng.integers(0, 2**63, 900, dtype=np.uint64), rng.integers(0, 2**63, 100, dtype=np.uint64)
    sets += [a, np.concatenate([a[:800], b])]
    s = similarity_sketch(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]), 128)
    assert (s != np.uint64(2**64 - 1)).all()
    assert abs((s[4] == s[5]).mean() - 0.8) < 0.15


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(80)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if x in got} and {x for e in edges for x in e if e[0] != e[1]} <= set(got)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    only = near_duplicates(frame(spark, [(4, None, None, None, None), (2, "", None, None, 0)])).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in only} == {(4, 0, 4, True), (2, 0, 2, True)}
