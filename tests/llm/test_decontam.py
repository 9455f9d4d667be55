"""Decontamination against a plain search."""

import hashlib

from lanewatch.llm.decontam import contamination, decontaminate
from tests.llm.cases import SCHEMA, alnum_words, clashing, corpus, frame, words

import random


def _case():
    rng = random.Random(5)
    items = [(1, " ".join(words(rng, 25))), (2, " ".join(words(rng, 10))), (10, "tiny item here"), (3, None), (4, " .. "),
             (5, "tiny item here"), (None, " ".join(words(rng, 12)))]
    docs = corpus()
    n = len(docs)
    texts = [f"{' '.join(words(rng, 30))}\n{items[0][1].upper()}, and so on", " ".join(words(rng, 9)) + " " + items[1][1],
             "see: Tiny, ITEM; here!", " ".join(items[0][1].split()[3:12]), items[6][1] + " tail",
             " ".join(items[0][1].split()[5:15]) + " x " + items[1][1]]
    return docs + [(n + i, t, None, None, len(t)) for i, t in enumerate(texts)], items


def _plain(text, items, n=10):
    ws = alnum_words(text)
    hit, ids = set(), set()
    for item, t in items:
        iw = alnum_words(t)
        if not iw:
            continue
        k = min(n, len(iw))
        wins = {tuple(iw[p:p + k]) for p in range(len(iw) - k + 1)}
        for p in range(len(ws) - k + 1):
            if tuple(ws[p:p + k]) in wins:
                hit.update(range(p, p + k))
                if item is not None:
                    ids.add(str(item))
    return len(ws), hit, ids


def test_counts_and_items(spark):
    docs, items = _case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {d[0]: _plain(d[1], items) for d in docs}
    for limit in (32 << 20, 200):                 # one block, and several passes
        got = {r.doc_id: r for r in contamination(clashing(frame(spark, docs)), bench, max_index_bytes=limit).collect()}
        assert len(got) == len(docs)
        for d, (n, hit, ids) in want.items():
            r = got[d]
            sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, len(hit), len(ids), sha, bool(hit))
            assert {x for s in r.spans for x in range(s.start, s.start + s.length)} == hit
    assert sum(bool(h) for _, h, _ in want.values()) == 5


def test_removal(spark):
    docs, items = _case()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = clashing(frame(spark, docs))
    for limit in (32 << 20, 200):
        out = decontaminate(df, bench, max_index_bytes=limit)
        assert out.columns == df.columns
        got = {r.doc_id: r for r in out.collect()}
        for d, text, _, _, n in docs:
            _, hit, _ = _plain(text, items)
            if not hit:
                assert got[d].text == text and got[d].n_chars == n and got[d]["_found"] == "own _found"
            else:
                assert alnum_words(got[d].text) == [w for i, w in enumerate(alnum_words(text)) if i not in hit]
                assert got[d].n_chars == len(got[d].text)
    kept = {r.doc_id for r in decontaminate(df, bench, remove="documents").collect()}
    assert kept == {d[0] for d in docs if not _plain(d[1], items)[1]}


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    none = spark.createDataFrame([], SCHEMA)
    assert contamination(none, bench).count() == 0 and decontaminate(none, bench).count() == 0
    assert contamination(frame(spark, corpus()), bench).filter("contaminated").count() == 0
