"""Word splitting and rolling hashes against regular expressions and plain sums."""

import random

import numpy as np
import pyarrow as pa

from lanewatch.llm import textops as t
from tests.llm.cases import alnum_words, corpus, plain_words


def _split(texts, table):
    w = t.split_words(pa.array(texts, pa.string()), table)
    return [[w.word(j).decode() for j in range(w.offsets[i], w.offsets[i + 1])] for i in range(len(texts))]


def test_words():
    texts = [r[1] for r in corpus()]
    assert _split(texts, t.PLAIN) == [plain_words(x) for x in texts]
    assert _split(texts, t.LOWER) == [plain_words(x, lower=True) for x in texts]
    assert _split(texts, t.ALNUM) == [alnum_words(x) for x in texts]
    assert _split([], t.PLAIN) == []


def test_sliced_arrays():
    texts = [None, "a b", "", "c dd", "e"]
    w = t.split_words(pa.array(texts, pa.string()).slice(1, 3), t.PLAIN)
    assert w.counts.tolist() == [2, 0, 2] and w.word(3) == b"dd"


def test_hashes_tell_words_apart():
    texts = ["a", "b", "ab", "abcdefgh", "abcdefghi", "abcdefghj", "x" * 300, "x" * 301, "a\0", "a"]
    h = t.split_words(pa.array(texts), t.PLAIN).hashes()
    assert len(set(h.tolist())) == len(set(texts)) and h[0] == h[-1]


def test_rolling():
    rng = random.Random(1)
    h = np.array([rng.getrandbits(64) for _ in range(80)], dtype=np.uint64)
    m = t.MULTIPLIERS[0]
    for k in (1, 2, 3, 10, 18, 35, 80):
        plain = [sum(int(h[i + j]) * pow(m, k - 1 - j, 2**64) for j in range(k)) % 2**64 for i in range(80 - k + 1)]
        assert (t.rolling(h, k) == t.mix(np.array(plain, dtype=np.uint64))).all()
    assert len(t.rolling(h, 81)) == 0


def test_slices_keep_every_row():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 50, 0, 7, 7, 7)] + [None], "i": list(range(7))})
    assert [x for s in t.slices(batch, "text", 10) for x in s.column("i").to_pylist()] == list(range(7))
