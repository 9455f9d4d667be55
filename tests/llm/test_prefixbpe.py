"""Prefix dynamic programming against tiktoken."""

import base64
import hashlib
import random
import string

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from lanewatch.llm import prefixbpe as B
from tests.llm.cases import SCHEMA, clashing, corpus, frame

PATH = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
MULTI = str(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
PATTERN = public_tokenizers.PATTERN
ODD = ["it's", "  ", "\n\n\n x", " naïve", "日本語 テキスト", "👍🏽", "<|endoftext|>", "a" * 3000, " " * 2000, "½", "\x00\x01", "don't 12x",
       "...!!!", " 　 x", "é", "'S's 'll", " \t a", "ß"]


@pytest.fixture(scope="module", params=[PATH, MULTI])
def both(request):
    vocabulary, pattern, pieces = B.encoder(request.param, PATTERN)
    return vocabulary, pattern, pieces, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=B.load_ranks(request.param),
                                                          special_tokens={})


def test_pieces(both):
    vocabulary, _, _, library = both
    rng = random.Random(1)
    for _ in range(3000):
        raw = bytes(rng.choice(b"ab .'st\xc3\xa9\xe2\x80er0 1\n") for _ in range(rng.randrange(1, 30)))
        assert vocabulary.encode_piece(raw) == library._encode_single_piece(raw)
    for _ in range(3000):
        raw = b"".join(vocabulary.token[rng.randrange(len(vocabulary.token))] for _ in range(rng.randrange(1, 5)))
        assert vocabulary.encode_piece(raw) == library._encode_single_piece(raw)


def test_compatible_is_what_merging_leaves(both):
    vocabulary = both[0]
    rng = random.Random(2)
    for _ in range(3000):
        a, b = rng.randrange(3000), rng.randrange(3000)
        parts = B.merged(vocabulary.token[a] + vocabulary.token[b], vocabulary.ranks)
        assert vocabulary.compatible(a, b) == (parts == [vocabulary.token[a], vocabulary.token[b]])


def test_texts(both):
    vocabulary, pattern, pieces, library = both
    for text in ODD + [t or "" for _, t, *_ in corpus()]:
        ids = np.frombuffer(b"".join(B.encode_parts(text, pattern, pieces)), dtype="<u4").tolist()
        assert ids == library.encode_ordinary(text)
        assert vocabulary.decode(ids) == text.encode()


def test_tokens_that_merging_never_makes():
    """A rank file may hold tokens that only a whole piece can be."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abcd": 257}
    vocabulary = B.Vocabulary(ranks)
    library = tiktoken.Encoding("odd", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    assert vocabulary.whole_only == {257}
    for text in ("abcd", "abcdab", "ab", "aabcd", "abab"):
        assert vocabulary.encode_piece(text.encode()) == library.encode_ordinary(text)
    encoded = B.Encoded(vocabulary, regex.compile(r"\S+"), "abc")
    encoded.append("d")
    assert encoded.ids == [257]
    encoded.append("x")
    assert encoded.ids == library.encode_ordinary("abcdx")


def test_appends(both):
    vocabulary, pattern, _, library = both
    rng = random.Random(3)
    for _ in range(60):
        encoded = B.Encoded(vocabulary, pattern)
        for _ in range(rng.randrange(1, 12)):
            encoded.append(rng.choice([*ODD, "word", " ", "in", "g ", "\n", "7"])[:40])
            assert encoded.ids == library.encode_ordinary(encoded.text)


def test_an_append_reads_the_last_piece_only(both):
    vocabulary, pattern, _, library = both
    encoded = B.Encoded(vocabulary, pattern, "some words here " * 2000 + "endin")
    before = encoded.read
    encoded.append("gs")
    assert encoded.ids == library.encode_ordinary(encoded.text) and encoded.read - before < 40


def test_edits(both):
    vocabulary, pattern, _, library = both
    rng = random.Random(4)
    for _ in range(120):
        text = "".join(rng.choice([*ODD[:7], "word", " the", " ", "ing", "\n\n", "42", "  "]) for _ in range(rng.randrange(0, 25)))
        encoded = B.Encoded(vocabulary, pattern, text)
        for _ in range(5):
            a = rng.randrange(len(encoded.text) + 1)
            b = min(len(encoded.text), a + rng.randrange(6))
            encoded.replace(a, b, rng.choice(["", " ", "x", "  ", "'s", "new words", "\n"]))
            assert encoded.ids == library.encode_ordinary(encoded.text), (text, encoded.text)


def test_an_edit_reads_near_it_only(both):
    vocabulary, pattern, _, library = both
    encoded = B.Encoded(vocabulary, pattern, " ".join(f"word{i}" for i in range(5000)))
    before = encoded.read
    encoded.replace(20_000, 20_003, "changed it")
    assert encoded.ids == library.encode_ordinary(encoded.text) and encoded.read - before < 60


def test_long_texts_in_parts(both, monkeypatch):
    _, pattern, pieces, library = both
    monkeypatch.setattr(B, "LONG", 100)
    text = "  ".join(ODD)
    parts = list(B.encode_parts(text, pattern, pieces, many=7))
    assert len(parts) > 5 and np.frombuffer(b"".join(parts), dtype="<u4").tolist() == library.encode_ordinary(text)


def test_remembered_pieces_are_bounded(both):
    pieces = B.Pieces(both[0], limit=10)
    for n in range(100):
        assert pieces[f"p{n % 37}"] == b"".join(i.to_bytes(4, "little") for i in both[0].encode_piece(f"p{n % 37}".encode()))
        assert len(pieces) <= 10 and len(pieces.old) <= 10


def test_documents(spark):
    docs = corpus()
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=B.load_ranks(PATH), special_tokens={})
    got = {r.doc_id: r for r in B.digests(clashing(frame(spark, docs)), PATH, PATTERN).collect()}
    assert len(got) == len(docs)
    for d, text, *_ in docs:
        ids = library.encode_ordinary(text or "")
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_round_trip(spark):
    docs = corpus() + [(900 + i, t, None, None, 1) for i, t in enumerate(ODD)]
    tokens = B.encode(clashing(frame(spark, docs)), PATH, PATTERN)
    back = {r.doc_id: bytes(r.data) for r in B.decode(tokens, PATH, PATTERN).collect()}
    assert back == {d: (t or "").encode() for d, t, *_ in docs}


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert B.digests(none, PATH, PATTERN).count() == 0
    assert B.decode(B.encode(none, PATH, PATTERN), PATH, PATTERN).count() == 0


def test_ranks_file(tmp_path):
    """Any rank file with all bytes will do."""
    ranks = {bytes([b]): b for b in range(256)} | {b"th": 256, b"the": 257, b" the": 258, b"he": 259}
    file = tmp_path / "own.tiktoken"
    file.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for t, i in ranks.items()))
    vocabulary, pattern, pieces = B.encoder(str(file), PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("the " + string.ascii_lowercase[:3]) for _ in range(20))
        assert np.frombuffer(b"".join(B.encode_parts(text, pattern, pieces)), dtype="<u4").tolist() == library.encode_ordinary(text)
