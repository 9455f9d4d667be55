"""Byte-level BPE by prefix dynamic programming: the last token of every byte prefix.

The encoding of a piece (a match of the splitting pattern) is known from one token per
prefix: of the vocabulary's tokens that end a prefix, exactly one can follow the encoding
of what is before it, namely the one that is compatible with the last token there. Two
tokens are compatible if merging their joined bytes gives back the two. So a piece is read
once from left to right (all tokens ending at each byte come from an Aho-Corasick
automaton), its ids are read off backwards, bytes can be appended to the table, and after
an edit the table is valid up to it.

Compatibility needs no merging: the left token's right edge (itself, its right half, that
one's right half, ...) and the right token's left edge are all the tokens that ever meet at
the border; the pair is torn if two that exist at the same time join to a token of lower rank
than what ends either of them (on a tie the merge further left goes first).

A whole text is its pieces one after another. ``Encoded`` keeps pieces and tables: an
append re-reads the last piece alone; an edit re-reads from the last piece before it that
cannot see it to the first old piece border behind it.

Spark: one scan, no shuffle; texts go through in slices, pieces are remembered in two
generations of bounded size per worker, very long texts piece by piece.

Defined results: null counts as empty (no ids, digest of nothing); special tokens' strings
are ordinary text; a piece that is itself a token is that token, as in tiktoken; single
bytes are all tokens; equal rows give equal results; no rows give no rows; other columns
are not read. Surrogates do not occur in Spark strings.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import islice
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewatch.llm import textops
from lanewatch.llm.common import read, register

#: texts of more characters are split piece by piece instead of into one list
LONG = 1 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens of a piece by merging, lowest rank first, leftmost on ties (used for the vocabulary's own tokens)."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        found = [(r, i) for i in range(len(parts) - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        if not found:
            break
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Vocabulary:
    """Tokens, their halves, and which may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.token[i] = t
        self.halves: dict[int, tuple[int, int]] = {}          # the merge that makes a token
        #: tokens that merging never makes: they stand for whole pieces only
        self.whole_only: set[int] = set()
        self.automaton = ahocorasick.Automaton()
        for t, i in sorted(ranks.items(), key=lambda x: x[1]):
            if len(t) > 1 and not self._split(t, i):
                self.whole_only.add(i)
            else:
                self.automaton.add_word(t.decode("latin-1"), (i, len(t)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}

    def _split(self, t: bytes, own: int) -> bool:
        lower = _Below(self.ranks, own)
        parts = merged(t, lower)
        if len(parts) != 2:
            return False
        self.halves[own] = (self.ranks[parts[0]], self.ranks[parts[1]])
        return True

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of two tokens leaves the two."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= 300_000:
                self.pairs.clear()
            known = self.pairs[a, b] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        ranks, token, halves = self.ranks, self.token, self.halves
        left, right = a, b
        ends_left = ends_right = len(token)        # rank of the merge that takes the border token away; none: never
        while True:
            join = ranks.get(token[left] + token[right])
            if join is not None and join < ends_left and join <= ends_right:
                return False
            # back in time: undo the later of the two merges, of the same token the right one
            made_left = left if left in halves else -1
            made_right = right if right in halves else -1
            if made_left < 0 and made_right < 0:
                return True
            if made_right >= made_left:
                ends_right, right = right, halves[right][0]
            else:
                ends_left, left = left, halves[left][1]

    # ---- one piece

    def extend(self, piece: bytes, last: list[int]) -> list[int]:
        """Last token of every prefix of a piece, ``last`` being those of its first ``len(last)`` prefixes."""
        at = len(last)
        if at == len(piece):
            return last
        token, compatible = self.token, self.compatible
        # tokens that end after ``at`` begin at most the longest token before it
        start = max(0, at - self.longest + 1)
        for end, (i, n) in self.automaton.iter(piece[start:].decode("latin-1")):
            end += start
            if end < len(last):
                continue
            before = end - n
            if before < 0 or compatible(last[before], i):
                last.append(i)
        if len(last) != len(piece):
            raise ValueError(f"no token ends prefix {len(last) + 1} of {piece[:100]!r}")
        return last

    @property
    def longest(self) -> int:
        if not hasattr(self, "_longest"):
            self._longest = max(map(len, self.token))
        return self._longest

    def read_off(self, last: list[int]) -> list[int]:
        """Ids of the piece that a table of last tokens describes."""
        ids, at = [], len(last)
        while at:
            ids.append(last[at - 1])
            at -= len(self.token[last[at - 1]])
        ids.reverse()
        return ids

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self.read_off(self.extend(piece, []))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class _Below:
    """Ranks below a limit."""

    def __init__(self, ranks: dict[bytes, int], limit: int):
        self.ranks, self.limit = ranks, limit

    def get(self, key: bytes) -> int | None:
        r = self.ranks.get(key)
        return r if r is not None and r < self.limit else None


# ---- texts

class Encoded:
    """A text's pieces with their tables; ``append`` and ``replace`` re-read only what can change."""

    def __init__(self, vocabulary: Vocabulary, pattern, text: str = ""):
        self.vocabulary, self.pattern = vocabulary, pattern
        self.text, self.starts, self.tables, self.ids_of = "", [], [], []
        self.read = 0                              # characters read, for tests and measurements
        self._rebuild(text, 0, 0, len(text))

    @property
    def ids(self) -> list[int]:
        return [i for ids in self.ids_of for i in ids]

    def _piece(self, piece: str, table: list[int]) -> tuple[list[int], list[int]]:
        raw = piece.encode()
        whole = self.vocabulary.ranks.get(raw)
        if whole is not None and whole in self.vocabulary.whole_only:
            return table, [whole]
        table = self.vocabulary.extend(raw, table)
        return table, [whole] if whole is not None else self.vocabulary.read_off(table)

    def _rebuild(self, text: str, keep: int, old_from: int, changed_to: int) -> None:
        """Read ``text`` anew behind its first ``keep`` pieces until, past ``changed_to``, a border of the old pieces from
        ``old_from`` (piece number) on is met."""
        shift = len(text) - len(self.text)
        at = self.starts[keep] if keep < len(self.starts) else len(self.text) if keep else 0
        starts, tables, ids = [], [], []
        old = self.starts
        join = len(old)
        while at < len(text):
            if at >= changed_to:
                k = bisect_left(old, at - shift, old_from)
                if k < len(old) and old[k] == at - shift:
                    join = k
                    break
            found = self.pattern.match(text, at)
            piece = found[0]
            table: list[int] = []
            if not starts and keep < len(old):     # the first re-read piece may share a prefix with the old one
                end = old[keep + 1] if keep + 1 < len(old) else len(self.text)
                raw_old, raw = self.text[old[keep]:end].encode(), piece.encode()
                same = 0
                while same < min(len(raw), len(raw_old), len(self.tables[keep])) and raw[same] == raw_old[same]:
                    same += 1
                table = self.tables[keep][:same]
            starts.append(at)
            got = self._piece(piece, table)
            tables.append(got[0])
            ids.append(got[1])
            self.read += len(piece)
            at += len(piece)
        self.starts = old[:keep] + starts + [s + shift for s in old[join:]]
        self.tables = self.tables[:keep] + tables + self.tables[join:]
        self.ids_of = self.ids_of[:keep] + ids + self.ids_of[join:]
        self.text = text

    def replace(self, start: int, end: int, new: str) -> None:
        """Characters start..end become ``new``."""
        text = self.text[:start] + new + self.text[end:]
        # a piece sees the white space behind it and one character more
        keep = bisect_left(self.starts, start)
        while keep:
            border = self.starts[keep] if keep < len(self.starts) else len(self.text)
            if border < start and not self.text[border:start].isspace():
                break
            keep -= 1
        self._rebuild(text, keep, bisect_left(self.starts, end), start + len(new))

    def append(self, new: str) -> None:
        self.replace(len(self.text), len(self.text), new)


class Pieces(dict):
    """Ids (bytes, little-endian 32 bits) by piece: a full generation becomes the old one, which is asked before encoding."""

    def __init__(self, vocabulary: Vocabulary, limit: int = 120_000):
        super().__init__()
        self.vocabulary, self.limit, self.old = vocabulary, limit, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            ids = self.vocabulary.encode_piece(piece.encode())
            found = b"".join(i.to_bytes(4, "little") for i in ids)
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found


_LOADED: dict[tuple[str, str], tuple] = {}     # one vocabulary and piece memory per Python worker


def encoder(path: str, pattern: str):
    key = path, pattern
    if key not in _LOADED:
        import regex
        vocabulary = Vocabulary(load_ranks(path))
        _LOADED[key] = vocabulary, regex.compile(pattern), Pieces(vocabulary)
    return _LOADED[key]


def encode_parts(text: str, pattern, pieces: Pieces, many: int = 100_000) -> Iterator[bytes]:
    """Ids of a text as bytes; a long text comes in parts of ``many`` pieces."""
    if len(text) <= LONG:
        yield b"".join(map(pieces.__getitem__, pattern.findall(text)))
        return
    found = (m[0] for m in pattern.finditer(text))
    while part := list(islice(found, many)):
        yield b"".join(map(pieces.__getitem__, part))


def encode(docs: DataFrame, path: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every document."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        _, pat, pieces = encoder(path, pattern)
        for whole in batches:
            for batch in textops.slices(whole, "text", 4 << 20):
                ids = [np.frombuffer(b"".join(encode_parts(t or "", pat, pieces)), dtype="<i4")
                       for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], schema.names)

    return slim.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str, *, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, data (bytes) of every row of ids."""
    slim = tokens.select(F.col(doc_id).alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    schema = T.StructType([slim.schema["doc_id"], T.StructField("data", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(path, pattern)[0]
        for batch in batches:
            for i in range(batch.num_rows):
                data = vocabulary.decode(batch.column("ids")[i].as_py() or [])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, 1), pa.array([data], pa.binary())], schema.names)

    return slim.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text is encoded and its ids are decoded, part by part."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([slim.schema["doc_id"], *T.StructType.fromDDL(
        "n_tokens long, ids_sha256 string, decoded_sha256 string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        vocabulary, pat, pieces = encoder(path, pattern)
        for whole in batches:
            for batch in textops.slices(whole, "text", 4 << 20):
                counts, coded, decoded = [], [], []
                for scalar in batch.column("text"):
                    n, a, b = 0, hashlib.sha256(), hashlib.sha256()
                    for part in encode_parts(scalar.as_py() or "", pat, pieces):
                        n += len(part) // 4
                        a.update(part)
                        b.update(vocabulary.decode(np.frombuffer(part, dtype="<u4").tolist()))
                    counts.append(n)
                    coded.append(a.hexdigest())
                    decoded.append(b.hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(coded, pa.string()),
                                                  pa.array(decoded, pa.string())], schema.names)

    return slim.mapInArrow(run, schema)


@register("op11_byte_bpe")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return digests(read(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
