"""Packing: ids against the whole tokenizer, bins against their definition."""

import bisect
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lanewatch.llm.packing import WordIds, pack, plan, sequences, word_vocabulary
from tests.llm.cases import SCHEMA, clashing, corpus, frame


def test_ids_equal_the_whole_tokenizer():
    texts = [r[1] or "" for r in corpus()]
    texts += ["don't can't I'M we'll they'd 'tis '' 's", "ÀÉÎ ÖØß ÿ × ÷ µ ª º ¼ ²", "é Å ﬁ İ ẞ Σας", "a b c\u0085d",
              "x<|endoftext|>y <|startoftext|> <|", "12345 1a2b3 #$%^&*() a-b_c", "한국어 हिन्दी 👍🏽 ‍", "\x00\x1c\x7f\x80"]
    tok = WordIds(word_vocabulary(), cache=50)
    ids, off = tok.batch(pa.array([*texts, None], pa.string()))
    whole = Tokenizer.from_file(word_vocabulary())
    for i, t in enumerate(texts):
        assert ids[off[i]:off[i + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids, t
    assert off[-1] == off[-2] == len(ids)


def _check_plan(h, capacity, rows):
    ranks, bins = defaultdict(list), defaultdict(list)
    for length, lo, hi, first, offset in rows:
        ranks[length].append((lo, hi))
        for k in range(hi - lo):
            bins[first + k].append((offset, length))
    for length, n in h.items():
        x = sorted(ranks[length])
        assert x[0][0] == 0 and x[-1][1] == n and all(a[1] == b[0] for a, b in zip(x, x[1:]))
    for v in bins.values():
        at = 0
        for offset, length in sorted(v):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def _best_fit(h, capacity):
    """Bins of plain best-fit decreasing."""
    room, n = [], 0
    for x in sorted(h, reverse=True):
        for _ in range(h[x]):
            i = bisect.bisect_left(room, x)
            r = room.pop(i) if i < len(room) else capacity
            n += r == capacity
            if r > x:
                bisect.insort(room, r - x)
    return n


@pytest.mark.parametrize("capacity,groups", [(4096, 24), (100, 6), (4096, 3)])
def test_plan(capacity, groups):
    rng = random.Random(capacity + groups)
    cases = [{}, {1: 7}, {capacity: 3, capacity - 1: 2, 1: 1}, dict(Counter(rng.randint(1, capacity) for _ in range(400))),
             dict(Counter(min(capacity, max(1, int(rng.lognormvariate(0.75 * np.log(capacity), 1)))) for _ in range(5000))),
             {capacity // 2 + 1: 50, capacity // 2 - 1: 50}, {capacity // 3 + 1: 1}]
    for h in cases:
        n = _check_plan(h, capacity, plan(h, capacity, groups=groups))
        least = -(-sum(k * v for k, v in h.items()) // capacity)
        assert least <= n
        assert n <= 1.02 * _best_fit(h, capacity) + 1


def test_plan_size_does_not_follow_the_corpus():
    h = dict(Counter(min(4096, max(1, int(random.Random(i).lognormvariate(6.3, 1)))) for i in range(3000)))
    few, many = plan(h), plan({k: v * 1000 for k, v in h.items()})
    assert len(many) < 12 * len(few) and len(many) < 40_000


def test_pack(spark):
    docs = corpus()
    docs += [docs[-1], docs[-1]]                       # repeated rows
    whole = Tokenizer.from_file(word_vocabulary())
    want = Counter()
    for d, t, *_ in docs:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want.update((d, k, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes()))
                    for k, s in enumerate(range(0, len(ids), 4096)))
    rows = pack(clashing(frame(spark, docs)), word_vocabulary()).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for v in bins.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 4096
    assert len(bins) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_sequences_hold_the_ids(spark):
    docs = corpus()[:60]
    placed = pack(frame(spark, docs), word_vocabulary(), capacity=64, with_ids=True)
    whole = Tokenizer.from_file(word_vocabulary())
    n = sum(len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, *_ in docs)
    rows = sequences(placed).collect()
    assert sum(len(r.ids) for r in rows) == n and max(len(r.ids) for r in rows) <= 64


def test_empty(spark):
    assert pack(spark.createDataFrame([], SCHEMA), word_vocabulary()).count() == 0
