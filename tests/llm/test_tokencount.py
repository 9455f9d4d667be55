"""Token counts against the offsets of another tokenizer library."""

import bisect
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lanewatch.llm.tokencount import attribute, encoder, sections_of, token_counts, token_spans
from tests.llm.cases import SCHEMA, clashing, corpus, frame

RANKS = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _offsets(text):
    tok = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    tok.encode_special_tokens = True
    return tok.encode(text, add_special_tokens=False).offsets


def test_counts(spark):
    docs = corpus()
    rows = token_counts(clashing(frame(spark, docs)), RANKS, public_tokenizers.PATTERN).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert len(by) == len(docs)
    for d, text, _, source, _ in docs:
        whole = f"{source}\n{text or ''}"
        own = sorted(by[d], key=lambda r: (r.start_char, r.field == "text", r.section))
        assert own[0].field == "source" and sum(r.n_chars for r in own) == len(whole)
        assert [r.section for r in own if r.field == "text"] == list(range(len(own) - 1))
        starts = [r.start_char for r in own]
        want = Counter(bisect.bisect_right(starts, a) - 1 for a, _ in _offsets(whole))
        assert [r.n_tokens for r in own] == [want[i] for i in range(len(own))]


def test_spans_equal_library_offsets():
    enc, lens = encoder(RANKS, public_tokenizers.PATTERN)
    for text in ["plain words here", "naïve café", "日本語 👍🏽", "", "\n\n a", "<|endoftext|>"]:
        a, b = token_spans(text, enc, lens)
        assert list(zip(a.tolist(), b.tolist())) == _offsets(text)


def test_rules():
    bounds = np.array([0, 4, 10, 11, 20])          # a token over 2..12 touches four sections, one over 8..14 three
    start, end = np.array([0, 2, 8, 14]), np.array([2, 12, 14, 20])
    assert [attribute(start, end, bounds, r)[0].tolist() for r in ("start", "end", "most")] == [
        [2, 1, 0, 1], [1, 0, 0, 3], [1, 1, 0, 2]]
    assert attribute(start, end, bounds, "most")[1].tolist() == [0, 1, 0, 1]
    tie = attribute(np.array([2]), np.array([6]), np.array([0, 4, 8]), "most")[0]
    assert tie.tolist() == [1, 0]


def test_sections():
    whole, bounds, names = sections_of(["s", "a\n\nb\n", ""])
    assert whole == "s\na\n\nb\n\n" and bounds.tolist() == [0, 2, 4, 5, 8, 8] and names == [(0, 0), (1, 0), (1, 1), (1, 2), (2, 0)]


def test_crossing_tokens(spark):
    """Runs of newlines are single tokens that cross lines; the counts still sum to the whole encoding."""
    docs = [(1, "a\n\n\n\n\nb", None, "s", 1), (2, "x\n\n", None, None, 1)]
    enc, _ = encoder(RANKS, public_tokenizers.PATTERN)
    for rule in ("start", "end", "most"):
        rows = token_counts(frame(spark, docs), RANKS, public_tokenizers.PATTERN, rule=rule).collect()
        assert sum(r.n_crossing for r in rows if r.doc_id == 1) >= 1
        for d, t, _, s, _ in docs:
            assert sum(r.n_tokens for r in rows if r.doc_id == d) == len(enc.encode_ordinary(f"{s or ''}\n{t}"))
    with pytest.raises(ValueError):
        token_counts(frame(spark, docs), RANKS, public_tokenizers.PATTERN, rule="none")


def test_empty(spark):
    assert token_counts(spark.createDataFrame([], SCHEMA), RANKS, public_tokenizers.PATTERN).count() == 0
