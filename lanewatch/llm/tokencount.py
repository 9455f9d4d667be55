"""Token counts by field and section: offset-mapped attribution.

The fields of a document are joined by a newline and encoded once, as a whole,
with a byte-level BPE (tiktoken). The tokens' bytes are the text's bytes, so
their character spans follow from the token lengths. Spans are then joined with
the sections (every line of every field, its newline included) by interval: both
lists are sorted, so each token finds the sections of its first and last
character by binary search. A token that crosses a boundary is given to one
section by ``rule``: ``start`` (where its first character lies), ``end`` (its
last), or ``most`` (the section with most of its characters, the first on a tie).
Counts therefore sum to the length of the whole encoding.

Defined results: a null field counts as empty; an empty field has one section,
which holds at most the newline that joins it to the next field; a token that
holds a part of a character touches that character; equal rows give equal results.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewatch.llm import textops
from lanewatch.llm.common import read, register

_LOADED: dict[str, tuple] = {}     # one encoder per Python worker


def encoder(path: str, pattern: str):
    """The encoder of a rank file, and the byte length of every id."""
    if path not in _LOADED:
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
        lens = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            lens[i] = len(token)
        _LOADED[path] = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lens
    return _LOADED[path]


def token_spans(text: str, enc, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans [start, end) that the tokens of a whole text touch."""
    ids = np.array(enc.encode_ordinary(text), dtype=np.int64)
    edge = np.concatenate([[0], np.cumsum(lens[ids])])
    if text.isascii():
        return edge[:-1], edge[1:]
    first = (np.frombuffer(text.encode(), dtype=np.uint8) & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(first)])     # characters begun before each byte
    return chars[edge[:-1] + 1] - 1, chars[edge[1:]]


def sections_of(fields: list[str]) -> tuple[str, np.ndarray, list[tuple[int, int]]]:
    """The joined text, the sections' character starts (and the end), and (field, section) of each."""
    whole = "\n".join(fields)
    starts, names, at = [], [], 0
    for f, value in enumerate(fields):
        lines = value.split("\n")
        if len(lines) > 1 and not lines[-1]:
            lines.pop()                       # a closing newline opens no section of its own
        for k, line in enumerate(lines):
            starts.append(at)
            names.append((f, k))
            at += len(line) + 1
        at = sum(len(x) + 1 for x in fields[:f + 1])
    return whole, np.array([*starts, len(whole)], dtype=np.int64), names


def attribute(start: np.ndarray, end: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and boundary-crossing tokens of every section (interval join of sorted spans)."""
    n = len(bounds) - 1
    last = np.maximum(end - 1, start)
    a = np.clip(np.searchsorted(bounds[:-1], start, side="right") - 1, 0, n - 1)
    b = np.clip(np.searchsorted(bounds[:-1], last, side="right") - 1, 0, n - 1)
    to = {"start": a, "end": b, "most": a.copy()}[rule]
    if rule == "most":
        for i in np.flatnonzero(b > a):
            cut = np.minimum(bounds[a[i] + 1:b[i] + 2], end[i]) - np.maximum(bounds[a[i]:b[i] + 1], start[i])
            to[i] = a[i] + int(cut.argmax())
    return np.bincount(to, minlength=n), np.bincount(to[b > a], minlength=n)


def token_counts(docs: DataFrame, path: str, pattern: str, *, doc_id: str = "doc_id", fields: tuple[str, ...] = ("source", "text"),
                 rule: str = "start") -> DataFrame:
    """A row per document, field and section: start_char, n_chars, n_tokens, n_crossing (given to it, crossing its edge)."""
    if rule not in ("start", "end", "most"):
        raise ValueError(f"rule: start, end or most, not {rule!r}")
    slim = docs.select(F.col(doc_id).alias("doc_id"),
                       *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)])
    schema = T.StructType([slim.schema["doc_id"], T.StructField("field", T.StringType()), T.StructField("section", T.IntegerType()),
                           T.StructField("start_char", T.LongType()), T.StructField("n_chars", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("n_crossing", T.LongType())])
    longest = f"f{len(fields) - 1}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, lens = encoder(path, pattern)
        for big in batches:
            for batch in textops.slices(big, longest, 4 << 20):
                row, field, section, out = [], [], [], [[], [], [], []]
                for i, values in enumerate(zip(*(batch.column(f"f{j}").to_pylist() for j in range(len(fields))), strict=True)):
                    whole, bounds, names = sections_of([v or "" for v in values])
                    n, crossing = attribute(*token_spans(whole, enc, lens), bounds, rule)
                    row.append(np.full(len(names), i))
                    field += [fields[f] for f, _ in names]
                    section += [k for _, k in names]
                    for held, part in zip(out, (bounds[:-1], np.diff(bounds), n, crossing), strict=True):
                        held.append(part)
                if row:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(np.concatenate(row))), pa.array(field, pa.string()),
                         pa.array(section, pa.int32()), *[pa.array(np.concatenate(c), pa.int64()) for c in out]], schema.names)

    return slim.mapInArrow(run, schema)


@register("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(read(spark, sf_dir, "documents"), str(public_tokenizers.path("byte_bpe_50k.tiktoken")),
                        public_tokenizers.PATTERN)
