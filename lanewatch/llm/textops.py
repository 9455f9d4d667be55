"""Word splitting and hashing over Arrow string batches (NumPy, whole batch at once).

A word is a maximal run of bytes outside a separator set. All separators used
here are ASCII, so splitting UTF-8 bytes equals splitting code points.
"""

from __future__ import annotations

import ctypes
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

M1 = np.uint64(0x9E3779B97F4A7C15)
M2 = np.uint64(0xD6E8FEB86659FD93)
MULTIPLIERS = (0xC2B2AE3D27D4EB4F, 0x9FB21C651E98DF25)
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def translation(separators: list[int], lower: bool) -> bytes:
    """Byte table: separators become a blank, A-Z optionally their lower case."""
    t = bytearray(range(256))
    if lower:
        for c in range(0x41, 0x5B):
            t[c] = c + 32
    for c in separators:
        t[c] = 0x20
    return bytes(t)


WHITE = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
#: words [^\x20\x09-\x0D]+, unchanged
PLAIN = translation(WHITE, lower=False)
#: words [^\x20\x09-\x0D]+ after lower-casing A-Z
LOWER = translation(WHITE, lower=True)
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = translation([c for c in range(0x80) if not (0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A)],
                    lower=True)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * M1
    h = (h ^ (h >> np.uint64(29))) * M2
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """Words of a batch of texts: ``offsets[i]:offsets[i+1]`` are those of text i."""

    data: bytes            # translated bytes of the batch, padded by 8
    starts: np.ndarray     # byte start of each word in data
    lens: np.ndarray       # byte length
    offsets: np.ndarray    # word index of each text's first word, n + 1 entries

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def word(self, i: int) -> bytes:
        s = int(self.starts[i])
        return self.data[s:s + int(self.lens[i])]

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        return hash_spans(self.data, self.starts, self.lens)


def text_bytes(col: pa.Array) -> tuple[bytes, np.ndarray]:
    """UTF-8 bytes and byte offsets of a string array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()) if not pa.types.is_large_binary(col.type) else col
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if n == 0:
        return b"", np.zeros(1, dtype=np.int64)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64)[col.offset:col.offset + n + 1]
    data = bufs[2].slice(int(off[0]), int(off[-1] - off[0])).to_pybytes() if bufs[2] is not None else b""
    return data, off - off[0]


def split_words(col: pa.Array, table: bytes) -> Words:
    data, off = text_bytes(col)
    data = data.translate(table)
    b = np.frombuffer(data, dtype=np.uint8)
    w = b != 0x20
    if len(b):
        first = w.copy()
        first[1:] &= ~w[:-1]
        last = w.copy()
        last[:-1] &= ~w[1:]
        edge = off[(off > 0) & (off < len(b))]      # a word ends where its text ends
        first[edge] |= w[edge]
        last[edge - 1] |= w[edge - 1]
        starts = np.flatnonzero(first)
        lens = np.flatnonzero(last) + 1 - starts
    else:
        starts = lens = np.zeros(0, dtype=np.int64)
    return Words(data + b"\0" * 8, starts, lens, np.searchsorted(starts, off))


def hash_spans(data: bytes, starts: np.ndarray, lens: np.ndarray, long: int = 256) -> np.ndarray:
    """64-bit hashes of byte spans; ``data`` has 8 spare bytes at its end."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        view = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
        x = view[starts] & _TAIL[np.minimum(lens, 8)]
        h = mix(x ^ (lens.astype(np.uint64) * M2))
        at = np.flatnonzero((lens > 8) & (lens <= long))
        k = 8
        while len(at):
            x = view[starts[at] + k] & _TAIL[np.minimum(lens[at] - k, 8)]
            h[at] = mix((h[at] * M1) ^ x)
            k += 8
            at = at[lens[at] > k]
        for i in np.flatnonzero(lens > long):
            h[i] = xxhash.xxh64_intdigest(data[starts[i]:starts[i] + lens[i]])
    return h


def rolling(h: np.ndarray, k: int, multiplier: int = MULTIPLIERS[0]) -> np.ndarray:
    """Hash of every run of k consecutive word hashes: entry i covers i..i+k-1.

    Built by doubling (runs of 1, 2, 4, ... joined), mod 2**64. The result has
    len(h) - k + 1 entries; runs over a text's end must be masked by the caller.
    """
    if len(h) < k:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        run, size, out, done = h, 1, None, 0
        while size <= k:
            if k & size:
                if out is None:
                    out = run
                else:
                    n = len(h) - done - size + 1
                    out = out[:n] * np.uint64(pow(multiplier, size, 2**64)) + run[done:done + n]
                done += size
            n = len(h) - 2 * size + 1
            if n > 0:
                run = run[:n] * np.uint64(pow(multiplier, size, 2**64)) + run[size:size + n]
            size *= 2
        return mix(out)


def run_starts(counts: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """Indices of words that start a run of k words inside their own text."""
    n = np.maximum(counts - k + 1, 0)
    total = int(n.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    first = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
    return np.arange(total) + first


def cover(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Mask of the positions covered by runs of ``length`` at ``starts``."""
    d = np.zeros(n + 1, dtype=np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + length, n), -1)
    return np.cumsum(d[:-1]) > 0


def slices(batch: pa.RecordBatch, column: str, limit: int = 8 << 20):
    """Cut a batch into pieces of about ``limit`` text bytes (a longer text is a piece of its own)."""
    n = batch.num_rows
    if n == 0:
        return
    off = offsets_of(batch.column(column))
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield batch.slice(lo, hi - lo)
        lo = hi
    give_back()


def give_back() -> None:
    """Workers are reused by later stages: return freed memory of this one to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc keeps freed pages otherwise
    if trim is not None:
        trim(0)


def offsets_of(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    lens = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lens)])
