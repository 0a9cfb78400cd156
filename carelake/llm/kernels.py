"""Numpy kernels over Arrow text columns: words, hashes and shingles of a whole batch at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex

U64 = np.uint64
_TABLE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_POW = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, U64))
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
PAD = U64(0x5851F42D4C957F2D)

#: Bytes hashed at a time; bounds the temporary arrays, whatever the length of a text.
HASHED_AT_ONCE = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the word."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not wide and not pa.types.is_string(texts.type) and not pa.types.is_binary(texts.type):
        texts, wide = texts.cast(pa.large_string()), True
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset: texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]: at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of about `limit` bytes of text; a longer text is a run of its own."""
    _, at = raw(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
        yield batch.slice(start, min(end, batch.num_rows) - start)
        start = end


@dataclass
class Words:
    """Words of several texts one after another; text d has those from `of[d]` to `of[d + 1]`."""

    hashes: np.ndarray
    of: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.of)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of) - 1), self.counts)


def words(texts: pa.Array, fold: bool = False) -> Words:
    """Words and their 64-bit hashes. `fold`: ASCII case and punctuation do not count."""
    data, at = raw(texts)
    gap = _GAP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(~gap & (np.concatenate(([True], gap[:-1])) | edge[:-1]) if len(data) else gap)
    ends = np.flatnonzero(~gap & (np.concatenate((gap[1:], [True])) | edge[1:]) if len(data) else gap) + 1
    table = np.where(_GAP, U64(0), _TABLE)
    if fold:
        codes = np.arange(256)
        lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
        table = table[lower]
        table[[c for c in range(33, 127) if not chr(c).isalnum()]] = 0
    hashes = np.empty(len(starts), U64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + HASHED_AT_ONCE, "right")))
        lo, hi = int(starts[first]), int(ends[last - 1])
        inside = np.arange(lo, hi) - np.repeat(starts[first:last], np.diff(np.append(starts[first:last], hi)))
        value = table[data[lo:hi]]
        if fold:  # the position of a letter is its place among the letters that count
            counted = np.cumsum(value != 0) - (value != 0)
            inside = counted - np.repeat(counted[starts[first:last] - lo], np.diff(np.append(starts[first:last], hi)))
        value *= _POW[inside & 1023]
        value *= (2 * (inside >> 10) + 1).astype(U64)
        hashes[first:last] = np.add.reduceat(value, starts[first:last] - lo)
        first = last
    return Words(mix(hashes), np.searchsorted(starts, at), starts, ends)


def shingles(w: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by text) of the runs of `size` words; a shorter text with a word is one shingle."""
    n = len(w.hashes)
    out = np.zeros(n, U64)
    left = np.repeat(w.of[1:], w.counts) - np.arange(n)
    for k in range(size):
        value = np.full(n, PAD, U64)
        if k < n:
            value[: n - k] = w.hashes[k:]
        out += np.where(left > k, value, PAD) * _POW[k + 7]
    counts = np.where(w.counts > 0, np.maximum(w.counts - size + 1, 1), 0)
    offsets = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(int(offsets[-1])) - np.repeat(offsets[:-1], counts) + np.repeat(w.of[:-1], counts)
    return mix(out[at]), offsets


def occurrence(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How many equal values of the same text stand before in sorted order: 0 for the first of them."""
    key = values ^ mix(doc.astype(U64) + U64(1))
    order = np.argsort(key, kind="stable")
    seen = key[order]
    fresh = np.ones(len(seen), bool)
    fresh[1:] = seen[1:] != seen[:-1]
    at = np.arange(len(seen))
    out = np.empty(len(seen), np.int64)
    out[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return out


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the lesser over sum of the greater counts; 0 if either is empty."""
    if not len(a) or not len(b):
        return 0.0
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[ia], cb[ib]).sum())
    return both / (len(a) + len(b) - both)


def text_words(text: str | None) -> list[bytes]:
    """Words of one text; bytes.split() parts at exactly the six gap characters."""
    return (text or "").encode("utf-8", "surrogatepass").split()


LETTER = regex.compile(r"\p{L}")
