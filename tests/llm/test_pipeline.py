"""The corpus pipeline stage by stage against brute force."""

from collections import Counter, defaultdict

import numpy as np
import zlib
from tokenizers import Tokenizer

import corpus_pipeline
from lanewatch.llm.packing import word_vocabulary
from tests.llm.cases import alnum_words, corpus, frame, plain_words
from tests.llm.test_decontam import _case, _plain as hit_words
from tests.llm.test_neardup import _plain as groups
from tests.llm.test_substring import _plain as repeats


def test_stages(spark, tmp_path):
    docs, items = _case()
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    df, got = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = df.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, df, str(tmp_path)).write.parquet(f"{tmp_path}/stage{k}")
        df = spark.read.parquet(f"{tmp_path}/stage{k}")
        got[name] = df.collect()
        assert k == 4 or df.columns == columns

    rows = {r.doc_id: r for r in got["language id"]}
    assert {d: r.text for d, r in rows.items()} == {d[0]: d[1] for d in docs if d[1] and any(c.isalpha() for c in d[1])}

    before = [tuple(r) for r in got["language id"]]
    want = {d for d, x in groups(before, 5, 80).items() if x[2]}
    assert {r.doc_id for r in got["near dedup"]} == want

    before = [tuple(r) for r in got["near dedup"]]
    found = {r.doc_id: r.text for r in got["substring dedup"]}
    for d, (w, gone) in repeats(before, 35).items():
        if gone:
            assert plain_words(found[d]) == [x for i, x in enumerate(w) if i not in gone]
        else:
            assert found[d] == rows[d].text

    clean = {r.doc_id: r for r in got["benchmark decontamination"]}
    assert set(clean) == set(found)
    for d, text in found.items():
        _, hit, _ = hit_words(text, items)
        assert alnum_words(clean[d].text) == [x for i, x in enumerate(alnum_words(text)) if i not in hit]
        assert hit or clean[d].text == text

    tok, ids = Tokenizer.from_file(word_vocabulary()), Counter()
    for d, r in clean.items():
        own = np.array([*tok.encode(r.text, add_special_tokens=False).ids, 1], dtype="<u4")
        ids.update((d, k, zlib.crc32(own[s:s + 4096].tobytes())) for k, s in enumerate(range(0, len(own), 4096)))
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in got["best-fit packing"]) == ids
    used = defaultdict(int)
    for r in got["best-fit packing"]:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 4096

    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in whole) == ids


def test_empty_documents(spark, tmp_path):
    frame(spark, corpus()).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "some test item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
