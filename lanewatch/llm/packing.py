"""Best-fit packing of tokenised documents into fixed-length sequences by linear grouping.

The plan is made on the histogram of piece lengths alone: at most ``capacity``
numbers, however large the corpus. Large lengths, in descending order, fall into
groups of equal cardinality and count as their group's largest; the few sizes
left are packed by a configuration linear program (column generation with a
knapsack); the documents themselves then take the places of their group, and the
room they leave is filled best-fit, longest first, with everything else. Bins
with equal content are one run, so the plan is a bounded list of intervals
"ranks lo..hi of length L go to bins b.. at offset o". Spark ranks the pieces of
each length and looks their interval up.

Defined results: a null or empty text is the closing id alone; equal rows are
packed each on its own; an empty table gives no sequences.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewatch.llm import textops
from lanewatch.llm.common import bounded_batches, dense_index, kept, read, register

CAPACITY = 4096


class Remembered(dict):
    """Ids (bytes, little-endian 32 bits) by key: a full generation becomes the old one, which is asked before ``encode``."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.encode(key)
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = ids
        return ids


class WordIds:
    """Ids of the word-end BPE by ``tokenizers``, common words encoded once per worker.

    The vocabulary drops white space, so a text's ids are those of its
    blank-separated chunks. Plain chunks (printable ASCII and Latin letters, for
    which lower-casing and splitting are fixed) are split all at once and their
    pieces go to the BPE model directly; every other chunk goes through the whole
    tokenizer. Pieces are remembered over batches and partitions, in two
    generations of at most ``cache`` entries (some 50 MB in all).
    """

    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    #: the vocabulary's own splitting pattern, on lower-case plain chunks, one a line
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+|\n")

    def __init__(self, path: str, cache: int = 150_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.bytes = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.pieces, self.others = Remembered(self._piece, cache), Remembered(self._other, cache // 8)

    def _piece(self, p: str) -> bytes:
        if p == "\n":
            return b""
        parts = [p] if p.isascii() else [s for s, _ in self.bytes.pre_tokenize_str(p)]
        return np.array([t.id for s in parts for t in self.model.tokenize(s)], dtype="<u4").tobytes()

    def _other(self, c: str) -> bytes:
        return np.array(self.tokenizer.encode(c, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _coded(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of distinct chunks, plain ones first, and the ids' bounds by chunk in the given order."""
        plain = [bool(c and self.PLAIN.fullmatch(c) and "<|" not in c) for c in chunks]
        own = [c for c, p in zip(chunks, plain, strict=True) if p]
        pieces = self.PIECES.findall("\n".join(own).lower()) if own else []
        coded = list(map(self.pieces.__getitem__, pieces))
        lens = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        ends = np.concatenate([[0], np.cumsum(lens)])
        line = np.fromiter(map("\n".__eq__, pieces), dtype=bool, count=len(pieces))
        cut = np.concatenate([[0], np.flatnonzero(line), [len(pieces)]]) if own else np.zeros(1, dtype=np.int64)
        bounds = ends[cut]
        others = [self.others[c] if c else b"" for c, p in zip(chunks, plain, strict=True) if not p]
        more = bounds[-1] + np.concatenate([[0], np.cumsum(np.fromiter(map(len, others), dtype=np.int64, count=len(others)) // 4)])
        flat = np.frombuffer(b"".join(coded) + b"".join(others), dtype="<u4")
        is_plain = np.array(plain, dtype=bool)
        first, n = np.empty(len(chunks), dtype=np.int64), np.empty(len(chunks), dtype=np.int64)
        first[is_plain], n[is_plain] = bounds[:-1], np.diff(bounds)
        first[~is_plain], n[~is_plain] = more[:-1], np.diff(more)
        return flat, np.stack([first, n])

    def batch(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and each text's offsets into them."""
        split = pc.ascii_split_whitespace(col.fill_null("").cast(pa.large_string()))
        ends = split.offsets.to_numpy().astype(np.int64)
        words = split.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        flat, (first, lens) = self._coded(words.dictionary.to_pylist())
        at = words.indices.to_numpy(zero_copy_only=False)
        n = lens[at]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.arange(total[-1]) + np.repeat(first[at] - total[:-1], n)]
        return ids, total[ends - ends[0]]


_LOADED: dict[str, WordIds] = {}     # one tokenizer and word cache per Python worker


def _tokenizer(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def pieces(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document; ``docs`` has doc_id and text."""
    fields = [docs.schema["doc_id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for whole in batches:
            for batch in textops.slices(whole, "text", 4 << 20):
                ids, off = tok.batch(batch.column("text"))
                row, piece, start, length, crc, held = [], [], [], [], [], []
                for i in range(batch.num_rows):
                    own = np.append(ids[off[i]:off[i + 1]], np.array([end_id], dtype="<u4")).astype("<u4", copy=False)
                    for k, s in enumerate(range(0, len(own), capacity)):
                        part = own[s:s + capacity]
                        row.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            held.append(part.astype(np.int64))
                cols = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.array(held, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(run, T.StructType(fields))


def configurations(sizes: list[int], demand: list[int], capacity: int, steps: int = 400) -> list[tuple[np.ndarray, float]]:
    """Configurations (items per size) and how often to use them: column generation for the cutting-stock program."""
    g = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, dtype=float)
    for _ in range(steps):
        price = np.linalg.solve(basis.T, np.ones(g))
        best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        s, p = np.array(sizes), np.maximum(price, 0)
        for room in range(1, capacity + 1):
            fits = s <= room
            value = np.where(fits, best[np.maximum(room - s, 0)] + p, -1.0)
            k = int(value.argmax())
            if value[k] > best[room - 1] + 1e-12:
                best[room], pick[room] = value[k], k
            else:
                best[room] = best[room - 1]
        if best[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(g), capacity
        while room > 0:
            if pick[room] < 0:
                room -= 1
            else:
                column[pick[room]] += 1
                room -= sizes[pick[room]]
        move, x = np.linalg.solve(basis, column), np.linalg.solve(basis, need)
        ratio = np.where(move > 1e-9, x / np.where(move > 1e-9, move, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    x = np.linalg.solve(basis, need)
    return [(basis[:, k].astype(np.int64), float(x[k])) for k in range(g)]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, *, groups: int = 24,
         large: tuple[int, ...] = (8, 4, 3, 2)) -> list[tuple]:
    """Intervals (length, lo, hi, bin, offset): rank r in lo..hi-1 of that length goes to bin + r - lo.

    Grows with the number of distinct lengths (at most ``capacity``) and groups, not with the number of pieces.
    Lengths from capacity / ``large`` are grouped; of those thresholds the one with the fewest bins is taken (the
    first that reaches the bound total / capacity ends the search).
    """
    least = -(-sum(k * n for k, n in histogram.items()) // capacity)
    best, fewest = [], None
    for part in large:
        rows, bins = _plan(histogram, capacity, groups, max(1, capacity // part))
        if fewest is None or bins < fewest:
            best, fewest = rows, bins
        if fewest <= least:
            break
    return best


def _plan(histogram: dict[int, int], capacity: int, groups: int, large: int) -> tuple[list[tuple], int]:
    rank = dict.fromkeys(histogram, 0)      # ranks of each length already placed
    out: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def put(length: int, count: int, first_bin: int, offset: int) -> None:
        out.append((length, rank[length], rank[length] + count, first_bin, offset))
        rank[length] += count

    if histogram.get(capacity):
        put(capacity, histogram[capacity], 0, 0)
        bins = histogram[capacity]
    big = [(x, histogram[x]) for x in sorted(histogram, reverse=True) if large <= x < capacity and histogram[x]]
    room: dict[int, list[tuple[int, int]]] = {}       # free room -> runs (first bin, bins)
    total = sum(n for _, n in big)
    if total:
        each = max(1, -(-total // groups))
        parts: list[list[list[int]]] = [[]]           # per group: [length, count] in descending order
        for x, n in big:
            while n:
                free = each - sum(c for _, c in parts[-1])
                if not free:
                    parts.append([])
                    free = each
                parts[-1].append([x, min(n, free)])
                n -= min(n, free)
        sizes = [p[0][0] for p in parts]
        for config, often in configurations(sizes, [sum(c for _, c in p) for p in parts], capacity):
            often = int(often + 1e-6)
            slots = [k for k in range(len(sizes)) for _ in range(config[k])]
            if not often or not slots:
                continue
            taken = []                                # per place of the configuration: runs of [length, count]
            for k in slots:
                own, want = [], often
                while want and parts[k]:
                    x, n = parts[k][0]
                    use = min(n, want)
                    own.append([x, use])
                    want -= use
                    parts[k][0][1] -= use
                    if not parts[k][0][1]:
                        parts[k].pop(0)
                if want:
                    own.append([0, want])             # the group ran out: the place stays free
                taken.append(own)
            done = 0
            while done < often:
                n = min(t[0][1] for t in taken)
                used = 0
                for t in taken:
                    if t[0][0]:
                        put(t[0][0], n, bins, used)
                        used += t[0][0]
                    t[0][1] -= n
                    if not t[0][1]:
                        t.pop(0)
                if used:
                    room.setdefault(capacity - used, []).append((bins, n))
                    bins += n
                done += n
    for x in sorted(histogram, reverse=True):         # best fit, longest first
        left = histogram[x] - rank[x]
        fits = [r for r in sorted(room) if r >= x]
        for r in fits:
            if left <= 0:
                break
            runs, per, rest = room.pop(r), r // x, []
            for first, n in runs:
                whole = min(n, left // per)
                if whole:
                    for j in range(per):
                        put(x, whole, first, capacity - r + j * x)
                    left -= whole * per
                    if r - per * x:
                        room.setdefault(r - per * x, []).append((first, whole))
                    first, n = first + whole, n - whole
                if n and 0 < left < per:
                    for j in range(left):
                        put(x, 1, first, capacity - r + j * x)
                    if r - left * x:
                        room.setdefault(r - left * x, []).append((first, 1))
                    first, n, left = first + 1, n - 1, 0
                if n:
                    rest.append((first, n))
            if rest:
                room.setdefault(r, []).extend(rest)
        per = capacity // x
        whole, over = divmod(max(left, 0), per)
        for n, items in ((whole, per), (1 if over else 0, over)):
            if n:
                for j in range(items):
                    put(x, n, bins, j * x)
                if capacity - items * x:
                    room.setdefault(capacity - items * x, []).append((bins, n))
                bins += n
    return out, bins


def pack(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         end_id: int = 1, with_ids: bool = False, **options) -> DataFrame:
    """Every piece with its sequence and offset: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]."""
    spark = docs.sparkSession
    bounded_batches(spark)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    cut = kept(pieces(slim, path, capacity=capacity, end_id=end_id, with_ids=with_ids))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan(histogram, capacity, **options)
    places = spark.createDataFrame(rows, "_length long, _lo long, _hi long, _bin long, offset long")
    ranked = dense_index(cut, "length", ["doc_id", "piece", "ids_crc32"], "_rank")
    at = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_lo")) & (F.col("_rank") < F.col("_hi"))
    return ranked.join(F.broadcast(places), at).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("_bin") + F.col("_rank") - F.col("_lo")).alias("sequence_id"),
        "offset", *(["ids"] if with_ids else []))


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids) of a packing made ``with_ids``: what a trainer reads."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))


def word_vocabulary() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


@register("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), word_vocabulary())
