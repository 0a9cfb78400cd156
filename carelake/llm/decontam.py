"""Benchmark passages inside documents: SimHash of item-sized windows, multi-index Hamming search, exact check.

Words are compared without ASCII case and punctuation. An item of n words is the multiset of its five-word shingles (of
its n-word shingle, if n < 5); a window is as many words of a document, at every place, or the whole document if it is
shorter. Both have a 64-bit SimHash in which a shingle weighs as often as it occurs. Items and windows of one size meet
in a multi-index of four 16-bit blocks: two fingerprints within `RADIUS` bits differ in some block by at most a quarter
of that, so looking up every block within that distance misses none of them. Candidates are then compared exactly, by
the weighted Jaccard similarity of their shingles, and count from `SIMILARITY` on. At that similarity fingerprints differ
in ten bits on average, with a deviation of three.

A window that has no shingle with any item in common has similarity 0 to all of them; no fingerprint is computed for it.

Items are broadcast in slices of at most `SLICE_BYTES` of text, however many there are; every slice meets all documents.
Null and empty texts and items match nothing. Rows and items with a null id are searched like others. Repeated rows give repeated
results, repeated items (same id and text) one. Other columns are not read, and are kept by `clean`.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from carelake.llm.common import arrow, blocks
from carelake.llm.kernels import U64, mix, pieces, shingles, weighted_jaccard, words

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCKS = 4
SLICE_BYTES = 16 << 20

#: Windows, and shingles under them, whose fingerprints are made at a time.
AT_ONCE = 1 << 15

_POP = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def simhash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of the runs [start, end) of shingles; a bit is set where more shingles have it than not."""
    signs = np.unpackbits(mix(values).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(2 * signs - 1, axis=0, dtype=np.int32)))
    return np.packbits(sums[ends] > sums[starts], axis=1).view(np.uint64).ravel()


def within(windows: np.ndarray, items: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) of all pairs of fingerprints within `radius`, by way of the blocks."""
    near = radius // BLOCKS
    halves = windows.view(np.uint16).reshape(-1, BLOCKS)
    others = items.view(np.uint16).reshape(-1, BLOCKS)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for b in range(BLOCKS):
        have, of_window = np.unique(halves[:, b], return_inverse=True)
        want, of_item = np.unique(others[:, b], return_inverse=True)
        order = np.argsort(of_item, kind="stable")
        first = np.searchsorted(of_item[order], np.arange(len(want) + 1))
        by_window = np.argsort(of_window, kind="stable")
        first_window = np.searchsorted(of_window[by_window], np.arange(len(have) + 1))
        for j in range(len(want)):
            close = np.flatnonzero(_POP[have ^ want[j]] <= near)
            if len(close):
                hit = np.concatenate([by_window[first_window[i]: first_window[i + 1]] for i in close])
                for item in order[first[j]: first[j + 1]]:
                    found.append((hit, np.full(len(hit), item)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate([w for w, _ in found]) * len(items) + np.concatenate([i for _, i in found]))
    w, i = np.divmod(pairs, len(items))
    far = sum(_POP[halves[w, b] ^ others[i, b]].astype(np.int64) for b in range(BLOCKS))
    return w[far <= radius], i[far <= radius]


class Items:
    """Benchmark items of one slice, by shingle size and number of words."""

    def __init__(self, rows: list[tuple[object, str]], radius: int, least: float) -> None:
        self.radius, self.least = radius, least
        w = words(pa.array([t for _, t in rows], pa.large_string()), fold=True)
        self.ids = [i for i, _ in rows]
        self.shingles: list[np.ndarray] = [np.zeros(0, U64)] * len(rows)
        #: shingle size -> words -> items
        self.sizes: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for size in range(1, SHINGLE + 1):
            values, offsets = shingles(w, size)
            for i, n in enumerate(w.counts.tolist()):
                if n and min(n, SHINGLE) == size:
                    self.shingles[i] = values[offsets[i]: offsets[i + 1]]
                    self.sizes[size][n].append(i)
        self.sizes = {k: dict(v) for k, v in self.sizes.items()}
        self.prints = {i: simhash(s, np.array([0]), np.array([len(s)]))[0]
                       for i, s in enumerate(self.shingles) if len(s)}
        self.sets = {(size, n): np.unique(np.concatenate([self.shingles[i] for i in items]))
                     for size, by in self.sizes.items() for n, items in by.items()}
        self.any = {size: np.unique(np.concatenate([self.sets[size, n] for n in by])) for size, by in self.sizes.items()}
        self.maybe = {}
        for size, values in self.any.items():
            self.maybe[size] = np.zeros(1 << 22, bool)
            self.maybe[size][values >> U64(42)] = True

    def find(self, texts: pa.Array) -> list[tuple[int, int, float, int]]:
        """(text, item, similarity, first word) of the best window of each item found in a text."""
        w = words(texts, fold=True)
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for size, by_words in self.sizes.items():
            values, offsets = shingles(w, size)
            hits = np.flatnonzero(self.maybe[size][values >> U64(42)])
            hits = hits[np.isin(values[hits], self.any[size])]
            if not len(hits):
                continue
            doc = np.searchsorted(offsets, hits, "right") - 1
            for n, items in by_words.items():
                own = np.isin(values[hits], self.sets[size, n])
                starts, ends = _windows(hits[own], offsets[doc[own]], offsets[doc[own] + 1], n - size + 1)
                prints = np.array([self.prints[i] for i in items])
                for lo, hi in _runs(starts, ends):
                    s, e = starts[lo:hi], ends[lo:hi]
                    local, at = _gather(values, s, e)
                    for x, y in zip(*within(simhash(local, at, at + (e - s)), prints, self.radius), strict=True):
                        like = weighted_jaccard(values[s[x]: e[x]], self.shingles[items[y]])
                        if like >= self.least:
                            d = int(np.searchsorted(offsets, s[x], "right") - 1)
                            key, value = (d, items[y]), (like, -int(s[x] - offsets[d]))
                            best[key] = max(best.get(key, (0.0, 0)), value)
        return [(d, i, like, -at) for (d, i), (like, at) in sorted(best.items())]


def _windows(hits: np.ndarray, lo: np.ndarray, hi: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All runs of n shingles around the hits, inside their texts [lo, hi); a shorter text is one run."""
    if not len(hits):
        return hits, hits
    start = hits[:, None] - np.arange(n)
    last = np.maximum(hi - n, lo)[:, None]
    inside = (start >= lo[:, None]) & (start <= last)
    row, _ = np.nonzero(inside)
    starts = np.concatenate((start[inside], lo[hi - lo < n]))
    tops = np.concatenate((hi[row], hi[hi - lo < n]))
    starts, first = np.unique(starts, return_index=True)
    return starts, np.minimum(starts + n, tops[first])


def _runs(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    for lo in range(0, len(starts), AT_ONCE):
        yield lo, min(lo + AT_ONCE, len(starts))


def _gather(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles under sorted windows without the gaps between them, and where each window starts there."""
    before = np.concatenate(([starts[0]], np.maximum.accumulate(ends)[:-1]))
    fresh = np.maximum(starts, before)
    count = np.maximum(ends - fresh, 0)
    offsets = np.cumsum(count) - count
    take = np.arange(int(count.sum())) - np.repeat(offsets, count) + np.repeat(fresh, count)
    return values[take], np.searchsorted(take, starts)


def slices(benchmark: DataFrame, radius: int, least: float) -> Iterator[Items]:
    rows = benchmark.select("item_id", "text").where("text is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    for i, n in blocks(total, SLICE_BYTES):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).orderBy("item_id", "text")
        items = [(r.item_id, r.text) for r in part.toLocalIterator()]
        if items:
            yield Items(items, radius, least)


def found(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, least: float = SIMILARITY) -> DataFrame:
    """`doc_id`, `item_id`, `similarity` and `first_word` of the best window of every item in every document."""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, item_id {dict(benchmark.dtypes)['item_id']}, similarity double, first_word int"
    ids = to_arrow_type(benchmark.schema["item_id"].dataType)
    rows = docs.select("doc_id", "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for items in slices(benchmark, radius, least):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in batches:
                for run in pieces(batch, "text", 4 << 20):
                    hits = items.find(run.column("text"))
                    yield pa.RecordBatch.from_arrays([
                        run.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64())),
                        pa.array([items.ids[h[1]] for h in hits], ids),
                        pa.array([h[2] for h in hits], pa.float64()), pa.array([h[3] for h in hits], pa.int32()),
                    ], names=["doc_id", "item_id", "similarity", "first_word"])

        out = out.unionByName(arrow(rows, search, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, least: float = SIMILARITY) -> DataFrame:
    """The rows without any item, all columns."""
    for items in slices(benchmark, radius, least):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in batches:
                for run in pieces(batch, "text", 4 << 20):
                    good = np.ones(run.num_rows, bool)
                    good[[h[0] for h in items.find(run.column("text"))]] = False
                    yield run.filter(pa.array(good))

        docs = arrow(docs, keep, docs.schema)
    return docs
