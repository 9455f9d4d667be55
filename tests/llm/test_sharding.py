"""Sharding: balance, gapless slots, groups kept together."""

import zlib
from collections import Counter, defaultdict

import pytest

from lanewatch.llm.sharding import assign_shards
from tests.llm.cases import SCHEMA, clashing, corpus, frame


def _check(docs, rows, shards):
    assert len(rows) == len(docs)
    texts = {d[0]: d[1] for d in docs}
    slots = defaultdict(list)
    for r in rows:
        raw = None if texts[r.doc_id] is None else texts[r.doc_id].encode()
        assert r["size"] == len(raw or b"") + 1 and r.text_crc32 == (None if raw is None else zlib.crc32(raw))
        assert r.law == "rows" and 0 <= r.shard < shards and r.grown_shard is None
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def _groups(docs, rows):
    at = {r.doc_id: r.shard for r in rows}
    groups = defaultdict(list)
    for d in docs:
        if d[1] is not None:
            groups[d[1]].append(at[d[0]])
    return [g for g in groups.values() if len(g) > 1]


def test_many_small_groups_stay_whole(spark):
    docs = [(i, f"text {i // 3}" if i < 600 else f"single {i}", None, None, 1) for i in range(1500)]
    rows = assign_shards(clashing(frame(spark, docs))).collect()
    _check(docs, rows, 16)
    assert all(len(set(g)) == 1 for g in _groups(docs, rows))


def test_a_group_larger_than_a_shard_fills_shards(spark):
    docs = [(i, "hot" if i < 700 else f"t{i}", None, None, 1) for i in range(2000)]
    rows = assign_shards(frame(spark, docs)).collect()
    _check(docs, rows, 16)
    hot = _groups(docs, rows)[0]
    assert len(set(hot)) <= 8           # 700 rows need 6 shards of 125; the last cells of a shard may lie apart


def test_all_rows_linked(spark):
    docs = [(i, f"t{i % 7}", None, None, 1) for i in range(1000)]
    _check(docs, assign_shards(frame(spark, docs)).collect(), 16)


def _kept(docs, rows):
    """Share of the pairs of equal texts that are in one shard."""
    both = together = 0
    for g in _groups(docs, rows):
        both += len(g) * (len(g) - 1)
        together += sum(n * (n - 1) for n in Counter(g).values())
    return together / both


@pytest.mark.parametrize("sizes, singles, possible", [
    ([4] * 1000, 0, 0.99),                     # every row linked: 62 whole groups a shard, 2 rows of another
    ([1300] * 7, 900, 0.46),                   # each group fills two shards of 625, 50 rows are left
    ([600] * 3, 4200, 0.51),                   # a shard of 375 and 225 in another
    ([4] * 500, 2000, 1.0),
    ([200, 150, 90, 60, 40, 30, 20] * 4 + [2] * 700, 240, 0.95)])
def test_links_kept(spark, sizes, singles, possible):
    texts = [f"group {g}" for g, n in enumerate(sizes) for _ in range(n)] + [f"single {i}" for i in range(singles)]
    docs = [(i, t, None, None, 1) for i, t in enumerate(texts)]
    rows = assign_shards(frame(spark, docs)).collect()
    _check(docs, rows, 16)
    assert _kept(docs, rows) >= 0.9 * possible


def test_the_round_limit_is_an_error(spark):
    docs = [(i, f"t{i % 7}", None, None, 1) for i in range(1000)]
    with pytest.raises(RuntimeError):
        assign_shards(frame(spark, docs), rounds=1)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(spark, n):
    docs = corpus()[:n]
    rows = assign_shards(spark.createDataFrame(docs, SCHEMA)).collect()
    _check(docs, rows, 16)


def test_edge_cases_and_plan(spark):
    docs = corpus()
    df = assign_shards(frame(spark, docs), shards=5)
    _check(docs, df.collect(), 5)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
