"""Benchmark decontamination: a broadcast set of normalised test n-grams.

Each benchmark item gives its windows of ``n`` consecutive words (an item with
fewer words, but not none, is one window). Their hashes go to every task; the
documents' rolling windows are looked up there, candidates are verified word by
word, and the hit words are reported or cut out. Documents are never shuffled.

The index is broadcast only up to ``max_index_bytes`` of item text. Larger item
sets are cut into blocks of that size and the documents pass through the blocks
one after another (checkpointed in between, so one block is in memory at a time).

Defined results: a null or empty text has no words and is clean; a null or empty
item has no windows; an item whose id is null still marks words but is not
counted as an item; equal ids count once; equal rows give equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewatch.llm import textops
from lanewatch.llm.common import kept, read, register, replace_columns

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                     T.StructField("item", T.StringType())])


class Index:
    """Windows of a block of items: per window length the sorted hashes and the items' words they start at."""

    def __init__(self, rows: list[tuple[str | None, str]], n: int):
        self.items = [item for item, _ in rows]
        self.words = textops.split_words(pa.array([t for _, t in rows], pa.large_string()), textops.ALNUM)
        self.item_of = self.words.doc_of().astype(np.int32)
        counts, offsets, h = self.words.counts, self.words.offsets, self.words.hashes()
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in sorted({min(n, int(c)) for c in np.unique(counts) if c}):
            # full windows of items of n words or more, and whole items of fewer words
            own = np.where(counts >= n, counts, 0) if k == n else np.where(counts == k, counts, 0)
            at = textops.run_starts(own, offsets, k)
            hashes = textops.rolling(h, k)[at]
            order = np.argsort(hashes, kind="stable")
            seen = np.zeros(1 << 20, dtype=bool)        # a first filter on 20 bits
            seen[(hashes >> np.uint64(44)).astype(np.int64)] = True
            self.by_length[k] = hashes[order], at[order], seen

    def find(self, words: textops.Words) -> list[tuple[int, int, int, frozenset]]:
        """Verified hits (text, first word counted in the batch, length, item ids)."""
        if not len(words):
            return []
        h, doc, hits = words.hashes(), None, []
        for k, (hashes, places, seen) in self.by_length.items():
            starts = textops.run_starts(words.counts, words.offsets, k)
            if not len(starts):
                continue
            x = textops.rolling(h, k)[starts]
            near = np.flatnonzero(seen[(x >> np.uint64(44)).astype(np.int64)])
            lo, hi = (np.searchsorted(hashes, x[near], side=side) for side in ("left", "right"))
            ok = hi > lo
            if ok.any() and doc is None:
                doc = words.doc_of()
            for s, a, b in zip(starts[near[ok]].tolist(), lo[ok].tolist(), hi[ok].tolist(), strict=True):
                own = [words.word(i) for i in range(s, s + k)]
                items = frozenset(self.items[self.item_of[p]] for p in places[a:b].tolist()
                                  if all(self.words.word(p + j) == w for j, w in enumerate(own)))
                if items:
                    hits.append((int(doc[s]), s, k, items))
        return hits


def cut_words(data: bytes, words: textops.Words, lo: int, hi: int, end: int, begin: int, gone: np.ndarray) -> bytes:
    """Bytes begin..end of a text without its words lo..hi where ``gone``.

    A cut word takes the separators up to the next word with it.
    """
    parts, at = [], begin
    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[lo:hi], [False]]).astype(np.int8)))
    for a, b in edge.reshape(-1, 2).tolist():
        parts.append(data[at:int(words.starts[lo + a])])
        at = int(words.starts[lo + b]) if lo + b < hi else end
    parts.append(data[at:end])
    return b"".join(parts)


def _blocks(items: DataFrame, item_id: str, item_text: str, limit: int) -> list[DataFrame]:
    size = items.agg(F.coalesce(F.sum(F.octet_length(item_text) + 16), F.lit(0))).first()[0]
    n = max(1, -(-int(size) // limit))
    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")) \
        .filter("text is not null").distinct()
    return [rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b) for b in range(n)] if n > 1 else [rows]


def _passes(spark: SparkSession, docs: DataFrame, items: DataFrame, n: int, text: str, item_id: str, item_text: str,
            limit: int, finish, schema: T.StructType) -> DataFrame:
    blocks = _blocks(items, item_id, item_text, limit)
    extra = "_found"
    while extra in docs.columns:
        extra += "_"
    carried = replace_columns(docs, T.StructField(extra, T.ArrayType(SPAN)))
    df = docs
    for b, block in enumerate(blocks):
        index = spark.sparkContext.broadcast(Index([(r.item, r.text) for r in block.collect()], n))
        last = b == len(blocks) - 1

        def run(batches: Iterator[pa.RecordBatch], index=index, last=last) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in textops.slices(whole, text):
                    words = textops.split_words(batch.column(text), textops.ALNUM)
                    hits = index.value.find(words)
                    if extra in batch.schema.names:
                        for i, spans in enumerate(batch.column(extra).to_pylist()):
                            hits += [(i, int(words.offsets[i]) + x["start"], x["length"], frozenset([x["item"]]))
                                     for x in spans or ()]
                        batch = batch.drop_columns([extra])
                    yield finish(batch, words, hits) if last else _carry(batch, words, hits, extra)

        df = df.mapInArrow(run, schema if last else carried)
        if not last:
            df = kept(df)
    return df


def _carry(batch: pa.RecordBatch, words: textops.Words, hits: list, extra: str) -> pa.RecordBatch:
    spans: list[list] = [[] for _ in range(batch.num_rows)]
    for i, s, k, items in hits:
        spans[i] += [{"start": s - int(words.offsets[i]), "length": k, "item": x} for x in items]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("item", pa.string())]))
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], [*batch.schema.names, extra])


def _mask(words: textops.Words, hits: list) -> np.ndarray:
    gone = np.zeros(len(words), dtype=bool)
    for _, s, k, _ in hits:
        gone[s:s + k] = True
    return gone


def contamination(docs: DataFrame, items: DataFrame, *, n: int = 10, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", max_index_bytes: int = 16 << 20) -> DataFrame:
    """One row per document: word counts, items hit and the hit spans (word positions)."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([
        slim.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()), T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
        T.StructField("spans", T.ArrayType(T.StructType(SPAN.fields[:2])))])

    def finish(batch: pa.RecordBatch, words: textops.Words, hits: list) -> pa.RecordBatch:
        gone, ids = _mask(words, hits), {}
        for i, _, _, items in hits:
            ids.setdefault(i, set()).update(x for x in items if x is not None)
        total = np.concatenate([[0], np.cumsum(gone)])
        n_hit = total[words.offsets[1:]] - total[words.offsets[:-1]]
        spans: list[list] = [[] for _ in range(batch.num_rows)]
        for i in np.flatnonzero(n_hit).tolist():
            lo, hi = words.offsets[i], words.offsets[i + 1]
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[lo:hi], [False]]).astype(np.int8)))
            spans[i] = [{"start": a, "length": b - a} for a, b in edge.reshape(-1, 2).tolist()]
        sha = [hashlib.sha256(",".join(sorted(ids.get(i, ()))).encode()).hexdigest() for i in range(batch.num_rows)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(n_hit, pa.int64()),
             pa.array([len(ids.get(i, ())) for i in range(batch.num_rows)], pa.int64()), pa.array(sha, pa.string()),
             pa.array(n_hit > 0), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))],
            [f.name for f in schema.fields])

    return _passes(docs.sparkSession, slim, items.select(item_id, item_text), n, "text", item_id, item_text,
                   max_index_bytes, finish, schema)


def decontaminate(docs: DataFrame, items: DataFrame, *, n: int = 10, remove: str = "spans", text: str = "text",
                  n_chars: str | None = "n_chars", item_id: str = "item_id", item_text: str = "text",
                  max_index_bytes: int = 16 << 20) -> DataFrame:
    """The documents, all columns kept, without hit spans or (``remove="documents"``) without hit documents.

    Clean documents come back unchanged. ``n_chars`` (if the table has it) follows the text.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove: spans or documents, not {remove!r}")
    chars = n_chars if n_chars in docs.columns else None

    def finish(batch: pa.RecordBatch, words: textops.Words, hits: list) -> pa.RecordBatch:
        hit = sorted({i for i, *_ in hits})
        if remove == "documents":
            keep = np.ones(batch.num_rows, dtype=bool)
            keep[hit] = False
            return batch.filter(pa.array(keep))
        return replace_texts(batch, text, chars, words, _mask(words, hits), hit)

    return _passes(docs.sparkSession, docs, items.select(item_id, item_text), n, text, item_id, item_text,
                   max_index_bytes, finish, docs.schema)


def replace_texts(batch: pa.RecordBatch, text: str, chars: str | None, words: textops.Words, gone: np.ndarray,
                  hit: list[int]) -> pa.RecordBatch:
    """The batch with the texts ``hit`` cut to the words not ``gone``, and their lengths."""
    if not hit:
        return batch
    data, off = textops.text_bytes(batch.column(text))
    texts = batch.column(text).to_pylist()
    counts = batch.column(chars).to_pylist() if chars else None
    for i in hit:
        lo, hi = int(words.offsets[i]), int(words.offsets[i + 1])
        texts[i] = cut_words(data, words, lo, hi, int(off[i + 1]), int(off[i]), gone).decode()
        if counts:
            counts[i] = len(texts[i])
    cols = {text: texts} | ({chars: counts} if chars else {})
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[c], batch.schema.field(c).type) if c in cols else batch.column(c) for c in batch.schema.names],
        schema=batch.schema)


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS k, array_to_string(ws[p:p + least(10, len(ws)) - 1], ' ') AS win
  FROM i, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS t(p) WHERE len(ws) > 0),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (
  SELECT doc_id, k, p, array_to_string(ws[p:p + k - 1], ' ') AS win
  FROM w, ks, unnest(range(1, len(ws) - k + 2)) AS t(p) WHERE len(ws) >= k),
hit AS (SELECT dw.doc_id, dw.p, dw.k, iw.item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
pos AS (
  SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS x FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(len(w.ws), 0) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(its.ids, '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@register("op1_decontamination", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("spans")
