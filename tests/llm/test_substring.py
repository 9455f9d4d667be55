"""Substring dedup against a plain count of windows."""

import hashlib
from collections import Counter

import pytest

from lanewatch.llm.substring import remove_repeats, repeat_digest
from tests.llm.cases import SCHEMA, clashing, corpus, frame, plain_words


def _plain(docs, window):
    seen = Counter()
    for d in docs:
        w = plain_words(d[1])
        seen.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = {}
    for d in docs:
        w = plain_words(d[1])
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        out[d[0]] = (w, gone)
    return out


@pytest.mark.parametrize("window,unit", [(35, 2 << 20), (35, 3000), (4, 3000)])
def test_against_plain_count(spark, window, unit):
    docs = corpus()
    want = _plain(docs, window)
    df = clashing(frame(spark, docs))
    got = {r.doc_id: r for r in repeat_digest(df, window=window, unit_bytes=unit, per_part=5000).collect()}
    assert len(got) == len(docs)
    for d, (w, gone) in want.items():
        r = got[d]
        left = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest())
        assert {x for s in r.spans for x in range(s.start, s.start + s.length)} == gone
    assert any(0 < len(g) < len(w) for w, g in want.values())


def test_removal_keeps_clean_documents(spark):
    docs = corpus()
    want = _plain(docs, 35)
    df = clashing(frame(spark, docs))
    out = remove_repeats(df, unit_bytes=5000)
    assert out.columns == df.columns
    for r in out.collect():
        w, gone = want[r.doc_id]
        if gone:
            assert plain_words(r.text) == [x for i, x in enumerate(w) if i not in gone] and r.n_chars == len(r.text)
        else:
            assert r.text == docs[r.doc_id][1] and r.n_chars == docs[r.doc_id][4]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repeat_digest(none).count() == 0 and remove_repeats(none).count() == 0
    assert repeat_digest(frame(spark, [(1, None, None, None, None), (2, "", None, None, 0)])).filter("n_words > 0").count() == 0
