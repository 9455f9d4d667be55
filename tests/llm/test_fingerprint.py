"""Fingerprints: edited texts, equality, likeness, context freedom."""

import hashlib

from pyspark.sql import functions as F

from lanewatch.llm.fingerprint import anchors, fingerprints, passages, positioned, with_next
from tests.llm.cases import SCHEMA, clashing, corpus, frame, words

import random


def test_edited_text_and_likeness(spark):
    docs = corpus()
    df = fingerprints(clashing(frame(spark, docs)))
    got = {r.doc_id: r for r in df.collect()}
    order = sorted(docs, reverse=True)
    prints = {}
    for d, nxt in zip(order, order[1:] + order[:1]):
        t, n = d[1] or "", nxt[1] or ""
        edited = t[:len(t) - len(t) // 2] + n[:len(t) // 2]
        r = got[d[0]]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if t == n:
            assert r.near_next == 1
        if t.strip() and not n.strip():
            assert r.near_next == 0
    assert prints[""] == "" and len(set(prints.values())) > 60
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "MapIn" not in plan


def test_likeness_of_half_edited_texts(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(words(rng, 400, 9000)), None, None, 1) for i in range(60)]
    rows = fingerprints(frame(spark, docs)).collect()
    assert all(0.12 < r.near_edited < 0.6 and r.near_next < 0.1 for r in rows)


def test_next_over_many_ranges(spark):
    for ids in (list(range(-50, 950, 7)), [5], [3, 3, 3, 8, 8, 1], [*range(40), 10**12]):
        rows = [(i, f"t{i}", k) for k, i in enumerate(ids)]
        df = spark.createDataFrame(rows, "doc_id long, text string, h long").repartition(3)
        got = sorted(((r.doc_id, r.h, r.next_h) for r in with_next(df, ["h"], ["doc_id", "h"], rows_per_range=5).collect()),
                     reverse=True)
        want = sorted(((i, k) for _, i, k in [(0, i, k) for k, i in enumerate(ids)]), reverse=True)
        assert [(a, b) for a, b, _ in got] == want
        assert [c for *_, c in got] == [k for _, k in want[1:] + want[:1]]


def test_anchors_are_closed_syncmers(spark):
    """The same choice made in Python from Spark's own word hashes; a passage keeps its anchors in any context."""
    rng = random.Random(4)
    passage = words(rng, 60)
    texts = [" ".join(words(rng, 20) + passage + words(rng, 9)), " ".join(words(rng, 3) + passage), " ".join(passage),
             "a b", "", "A B", "tie tie tie tie tie tie"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    full = [set(r.a) for r in df.select("i", anchors(F.col("t"), size=10_000).alias("a")).orderBy("i").collect()]
    assert full[2] <= full[0] and full[2] <= full[1] and len(full[2]) > 57 * 0.4
    assert full[3] == full[5] and len(full[3]) == 1 and not full[4] and len(full[6]) == 1

    ws = passage
    h = [r[0] for r in spark.createDataFrame([(i, w) for i, w in enumerate(ws)], "i int, w string")
         .orderBy("i").select(F.xxhash64("w")).collect()]
    m = [r[0] for r in spark.createDataFrame([(i, h[i], h[i + 1]) for i in range(59)], "i int, a long, b long")
         .orderBy("i").select(F.xxhash64("a", "b")).collect()]
    keep = [tuple(m[i:i + 3]) for i in range(57) if min(m[i], m[i + 2]) <= min(m[i:i + 3])]
    want = {r[0] for r in spark.createDataFrame(keep, "a long, b long, c long")
            .select(F.shiftrightunsigned(F.xxhash64("a", "b", "c"), 16)).collect()}
    assert full[2] == want


def test_empty(spark):
    assert fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    one = fingerprints(frame(spark, [(7, None, None, None, None)])).collect()[0]
    assert (one.n_chars, one.fingerprint, one.edited_fingerprint, one.near_edited, one.near_next) == (0, "", "", 1.0, 1.0)


def test_passage_of_long_texts_is_found_by_position(spark):
    """A passage of 300 words in two texts of 20,000; the sketch of 64 values does not see it."""
    rng = random.Random(8)
    shared = words(rng, 300, 10**6)
    texts = [words(rng, a, 10**6) + shared + words(rng, 20_000 - a, 10**6) for a in (4_000, 15_000)]
    df = frame(spark, [(i, " ".join(t), None, None, 1) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in fingerprints(df).collect()}
    assert len(got[0].anchors) > 9_000 and [x.pos for x in got[0].anchors] == sorted(x.pos for x in got[0].anchors)
    best = max(got[0].next_passages, key=lambda x: x.anchors)
    assert 4_000 <= best.pos <= 4_002 and best.other == best.pos + 11_000 and 296 <= best.length <= 300
    half = max(got[0].edited_passages, key=lambda x: x.anchors)
    assert half.pos == half.other < 3 and half.length > 9_000


def test_passages_match_plain_python(spark):
    rng = random.Random(9)
    texts = ["", "a", "tie " * 50, "tie " * 30] + [" ".join(words(rng, n, v)) for n, v in ((40, 3), (60, 3), (300, 12), (200, 12))]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate((a, b) for a in texts for b in texts)], "i int, a string, b string")
    df = df.select("i", positioned(F.col("a")).alias("a"), positioned(F.col("b")).alias("b"))
    for r in df.select("*", passages(F.col("a"), F.col("b")).alias("p")).collect():
        at = {}
        for n, side in enumerate((r.a, r.b)):
            for x in side:
                at.setdefault(x.hash, ([], []))[n].append(x.pos)
        pairs = sorted((y - x, x) for xs, ys in at.values() for x, y in zip(xs, ys))
        want = []
        for off, pos in pairs:
            if want and want[-1][0] == off and pos - want[-1][2] <= 20:
                want[-1][2:] = [pos, want[-1][3] + 1]
            else:
                want.append([off, pos, pos, 1])
        assert [tuple(x) for x in r.p] == [(p, p + off, last - p + 4, n) for off, p, last, n in want]


def test_characters_where_there_are_no_words(spark):
    rng = random.Random(10)
    base = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(400))
    other = base[:200] + "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(200))
    rows = {r.doc_id: r for r in fingerprints(frame(spark, [(2, base, None, None, 1), (1, other, None, None, 1)])).collect()}
    assert len(rows[2].anchors) > 100 and 0.15 < rows[2].near_next < 0.6
    assert max(x.length for x in rows[2].next_passages) > 190
