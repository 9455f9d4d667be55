"""Substring dedup with fixed-block anchors.

A window of ``window`` words always contains a whole block of ``(window + 1) // 2``
words that starts at a multiple of that length in its document. These
non-overlapping blocks are the index; every rolling run of the same length probes
it. Windows around the hits are then compared by 96-bit keys, and overlapping
repeats join into maximal ones.

Documents are packed into units (a few MB of text, one compressed row each) that
stay where they are. Only keys travel: per unit and key range one sorted, delta
coded list goes out and one bit per key comes back, so both exchanges are small
against the text, and a key's copies inside a unit are merged before the shuffle.
A key range holds about ``per_part`` keys, whatever the size of the corpus.

Defined results: null and empty texts have no words; texts shorter than a window
lose nothing; equal rows repeat each other and are removed wholly if they hold a
window; all other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewatch.llm import textops
from lanewatch.llm.common import bounded_batches, kept, kept_by, read, register, shuffle_partitions
from lanewatch.llm.decontam import replace_texts

ZSTD = pa.Codec("zstd")
REQUEST = "part int, unit long, n long, keys binary, marks binary, checks binary"
REPLY = "unit long, part int, bits binary"


def _squeeze(a: np.ndarray) -> bytes:
    """Bytes of an array, plane by plane, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T
    planes = planes[[bool(p.any()) for p in planes]] if a.dtype == np.uint64 else planes
    return bytes([len(planes)]) + ZSTD.compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def _unsqueeze(raw: bytes, n: int, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.zeros((width, n), dtype=np.uint8)
    if raw[0] and n:
        planes[:raw[0]] = np.frombuffer(ZSTD.decompress(raw[1:], raw[0] * n, asbytes=True), np.uint8).reshape(raw[0], n)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _deltas(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def _pack(docs: DataFrame, text: str, size: int) -> DataFrame:
    """Units: (unit, words, body), the body an Arrow stream of some documents, all columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, held, held_bytes = TaskContext.get().partitionId(), 0, [], 0

        def unit() -> pa.RecordBatch:
            nonlocal n, held, held_bytes
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(held).combine_chunks()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(table)
            words = sum(len(textops.split_words(b.column(text), textops.PLAIN)) for b in held)
            n, held, held_bytes = n + 1, [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + n], pa.int64()), pa.array([words], pa.int64()),
                 pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["unit", "words", "body"])

        for whole in batches:
            for batch in textops.slices(whole, text, size):
                held.append(batch)
                held_bytes += int(textops.offsets_of(batch.column(text))[-1]) + 64 * batch.num_rows
                if held_bytes >= size:
                    yield unit()
        if held:
            yield unit()

    return docs.mapInArrow(run, "unit long, words long, body binary")


def _open(body: bytes) -> pa.RecordBatch:
    table = pa.ipc.open_stream(body).read_all().combine_chunks()
    return table.to_batches()[0]


class _Unit:
    """Words and window keys of a unit, computed alike in every pass."""

    def __init__(self, body: bytes, text: str, window: int, parts: int, bits: int):
        self.batch = _open(body)
        self.words = textops.split_words(self.batch.column(text), textops.PLAIN)
        self.h, self.window, self.block = self.words.hashes(), window, (window + 1) // 2
        self.parts, self.bits = parts, bits
        self.long = self.words.counts >= window      # others hold no window

    def starts(self, k: int) -> np.ndarray:
        counts = np.where(self.long, self.words.counts, 0)
        return textops.run_starts(counts, self.words.offsets, k)

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Run starts, their truncated keys, and whether the run is an index block."""
        at = self.starts(self.block)
        keys = textops.rolling(self.h, self.block)[at] >> np.uint64(64 - self.bits) if len(at) else at.astype(np.uint64)
        first = np.repeat(self.words.offsets[:-1], np.where(self.long, self.words.counts - self.block + 1, 0))
        return at, keys, (at - first) % self.block == 0

    def part_of(self, keys: np.ndarray, bits: int) -> np.ndarray:
        """Key ranges, equal shares of the key space (keys are sorted: so are the parts)."""
        top = (keys >> np.uint64(max(0, bits - 32))).astype(np.uint64)
        return ((top * np.uint64(self.parts)) >> np.uint64(min(bits, 32))).astype(np.int64)

    def candidates(self, replies: dict[int, bytes]) -> np.ndarray:
        """Starts of the windows that hold an anchor which occurs elsewhere too."""
        at, keys, _ = self.probes()
        if not len(at):
            return at
        u, inverse = np.unique(keys, return_inverse=True)
        hit = at[_answers(self.part_of(u, self.bits), replies)[inverse]]
        n = len(self.h)
        d = np.zeros(n + 1, dtype=np.int64)
        np.add.at(d, np.maximum(hit - (self.window - self.block), 0), 1)
        np.add.at(d, hit + 1, -1)
        windows = self.starts(self.window)
        return windows[np.cumsum(d[:-1])[windows] > 0]

    def window_keys(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (textops.rolling(self.h, self.window)[at],
                (textops.rolling(self.h, self.window, textops.MULTIPLIERS[1])[at] >> np.uint64(32)).astype(np.uint32))


def _answers(part: np.ndarray, replies: dict[int, bytes]) -> np.ndarray:
    """One bit per sorted key from the bit lists of its parts; a part without reply has none."""
    out = np.zeros(len(part), dtype=bool)
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(part)], strict=True):
        if (raw := replies.get(int(part[a]))) is not None:
            out[a:b] = np.unpackbits(np.frombuffer(ZSTD.decompress(raw, (b - a + 7) // 8, asbytes=True), np.uint8),
                                     count=b - a).astype(bool)
    return out


def _requests(unit: int, part: np.ndarray, keys: np.ndarray, marks: np.ndarray, checks: np.ndarray | None) -> pa.RecordBatch:
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    rows = []
    for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(part)], strict=True):
        rows.append({"part": int(part[a]), "unit": unit, "n": b - a, "keys": _squeeze(_deltas(keys[a:b])),
                     "marks": ZSTD.compress(np.packbits(marks[a:b], axis=None).tobytes(), asbytes=True),
                     "checks": None if checks is None else checks[a:b].tobytes()})
    kind = pa.schema([("part", pa.int32()), ("unit", pa.int64()), ("n", pa.int64()), ("keys", pa.binary()),
                      ("marks", pa.binary()), ("checks", pa.binary())])
    return pa.RecordBatch.from_pylist(rows, kind)


def _resolve(table: pa.Table) -> pa.Table:
    """Of one key range: which keys of each unit occur more than once (and, as anchors, in the index)."""
    rows = table.to_pylist()
    sizes = [r["n"] for r in rows]
    keys = np.concatenate([np.cumsum(_unsqueeze(r["keys"], r["n"], np.uint64), dtype=np.uint64) for r in rows])
    marks = np.concatenate([np.unpackbits(np.frombuffer(ZSTD.decompress(r["marks"], (2 * r["n"] + 7) // 8, asbytes=True),
                                                        np.uint8), count=2 * r["n"]).reshape(-1, 2) for r in rows])
    if rows[0]["checks"] is None:
        order = np.argsort(keys, kind="stable")
        new = np.diff(keys[order], prepend=~keys[order[:1]]) != 0
    else:
        checks = np.concatenate([np.frombuffer(r["checks"], np.uint32) for r in rows])
        order = np.lexsort((checks, keys))
        k, c = keys[order], checks[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])])
    edge = np.flatnonzero(new)
    copies = np.diff(np.append(edge, len(keys)))
    often = np.maximum.reduceat(marks[order, 0], edge).astype(bool) | (copies > 1)
    indexed = np.maximum.reduceat(marks[order, 1], edge).astype(bool)
    hit = np.zeros(len(keys), dtype=bool)
    hit[order] = np.repeat(often & indexed, copies)
    out, at = [], 0
    for r, n in zip(rows, sizes, strict=True):
        own, at = hit[at:at + n], at + n
        if own.any():
            out.append({"unit": r["unit"], "part": r["part"], "bits": ZSTD.compress(np.packbits(own).tobytes(), asbytes=True)})
    return pa.Table.from_pylist(out, pa.schema([("unit", pa.int64()), ("part", pa.int32()), ("bits", pa.binary())]))


def _exchange(requests: DataFrame, name: str) -> DataFrame:
    """Resolve all key ranges; the replies of a unit as one row (unit, name: list of (part, bits))."""
    replies = requests.groupBy("part").applyInArrow(_resolve, REPLY)
    return kept(replies.groupBy("unit").agg(F.collect_list(F.struct("part", "bits")).alias(name)))


def _by_part(column: pa.Array, i: int) -> dict[int, bytes]:
    return {x["part"]: x["bits"] for x in column[i].as_py() or ()}


def repeated_words(docs: DataFrame, finish, schema: T.StructType, *, text: str = "text", window: int = 35,
                   unit_bytes: int = 2 << 20, per_part: int = 8_000_000) -> DataFrame:
    """Apply ``finish(batch, words, gone)`` to the documents, unit by unit, with the mask of the repeated words."""
    spark = docs.sparkSession
    bounded_batches(spark)
    units = kept_by(_pack(docs, text, unit_bytes), shuffle_partitions(spark), "unit")
    total = int(units.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0])
    parts = max(shuffle_partitions(spark), -(-total // per_part))
    bits = min(64, max(32, total.bit_length() + 10))

    def load(batch: pa.RecordBatch, i: int) -> _Unit:
        return _Unit(batch.column("body")[i].as_py(), text, window, parts, bits)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                u = load(batch, i)
                _, keys, block = u.probes()
                order = np.argsort(keys, kind="stable")
                keys = keys[order]
                edge = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
                if len(edge):
                    marks = np.stack([np.diff(np.append(edge, len(keys))) > 1,
                                      np.logical_or.reduceat(block[order], edge)], axis=1)
                    keys = keys[edge]
                    yield _requests(batch.column("unit")[i].as_py(), u.part_of(keys, bits), keys, marks, None)

    found = _exchange(units.mapInArrow(anchors, REQUEST), "anchors")
    probed = units.join(found, "unit")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                u = load(batch, i)
                keys, checks = u.window_keys(u.candidates(_by_part(batch.column("anchors"), i)))
                if not len(keys):
                    continue
                order = np.lexsort((checks, keys))
                keys, checks = keys[order], checks[order]
                new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])])
                edge = np.flatnonzero(new)
                marks = np.stack([np.diff(np.append(edge, len(keys))) > 1, np.ones(len(edge), dtype=bool)], axis=1)
                keys, checks = keys[edge], checks[edge]
                yield _requests(batch.column("unit")[i].as_py(), u.part_of(keys, 64), keys, marks, checks)

    repeats = _exchange(probed.mapInArrow(windows, REQUEST), "repeats")

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                u = load(batch, i)
                gone = np.zeros(len(u.words), dtype=bool)
                if (replies := _by_part(batch.column("repeats"), i)):
                    at = u.candidates(_by_part(batch.column("anchors"), i))
                    keys, checks = u.window_keys(at)
                    order = np.lexsort((checks, keys))
                    keys, checks = keys[order], checks[order]
                    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])])
                    edge = np.flatnonzero(new)
                    hit = _answers(u.part_of(keys[edge], 64), replies)
                    gone = textops.cover(at[order][np.repeat(hit, np.diff(np.append(edge, len(keys))))], window, len(gone))
                yield finish(u.batch, u.words, gone)

    return units.join(found, "unit", "left").join(repeats, "unit", "left").mapInArrow(last, schema)


def repeat_digest(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = 35, **options) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the removed spans (word positions) of every document."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    schema = T.StructType([slim.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()),
                           T.StructField("spans", T.ArrayType(span))])

    def finish(batch: pa.RecordBatch, words: textops.Words, gone: np.ndarray) -> pa.RecordBatch:
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[words.offsets[1:]] - total[words.offsets[:-1]]
        sha, spans = [], []
        for i, t in enumerate(batch.column("text").to_pylist()):
            ws, own = (t or "").encode().split(), []
            if removed[i]:
                g = gone[words.offsets[i]:words.offsets[i + 1]]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
                own = [{"start": a, "length": b - a} for a, b in edge.reshape(-1, 2).tolist()]
                ws = [w for w, x in zip(ws, g.tolist(), strict=True) if not x]
            sha.append(hashlib.sha256(b" ".join(ws)).hexdigest())
            spans.append(own)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))], schema.names)

    return repeated_words(slim, finish, schema, window=window, **options)


def remove_repeats(docs: DataFrame, *, text: str = "text", n_chars: str | None = "n_chars", window: int = 35,
                   **options) -> DataFrame:
    """The documents, all columns, with the repeated words cut out; others come back unchanged."""
    chars = n_chars if n_chars in docs.columns else None

    def finish(batch: pa.RecordBatch, words: textops.Words, gone: np.ndarray) -> pa.RecordBatch:
        total = np.concatenate([[0], np.cumsum(gone)])
        hit = np.flatnonzero(total[words.offsets[1:]] - total[words.offsets[:-1]]).tolist()
        return replace_texts(batch, text, chars, words, gone, hit)

    return repeated_words(docs, finish, docs.schema, text=text, window=window, **options)


SQL = r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
x AS (SELECT doc_id, p, md5(array_to_string(ws[p:p + 34], ' ')) AS win
      FROM w, unnest(range(1, len(ws) - 33)) AS t(p) WHERE len(ws) >= 35),
r AS (SELECT win FROM x GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS q FROM x SEMI JOIN r USING (win)),
g AS (SELECT doc_id, list(q) AS qs, count(*) AS n FROM gone GROUP BY doc_id),
k AS (SELECT w.doc_id, string_agg(w.ws[i], ' ' ORDER BY i) AS kept
      FROM w LEFT JOIN g USING (doc_id), unnest(range(1, len(w.ws) + 1)) AS t(i)
      WHERE NOT coalesce(list_contains(g.qs, i), false) GROUP BY w.doc_id)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@register("op9_substring_dedup", SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(read(spark, sf_dir, "documents")).drop("spans")
