"""Near-duplicate documents by DartMinHash over weighted five-word shingles, banded, verified and grouped.

A document is the multiset of its five-word shingles (all its words, if fewer). Darts land on the plane of a shingle's
weight and a rank: a shingle counted c times owns c unit strips, and the darts of a strip are a Poisson process along
the rank that depends on the strip alone. A document throws only as far as it has to: up to rank `theta`, where about
k (ln k + 4) darts have landed in its strips. Every dart belongs to one of k coordinates; a coordinate keeps its
earliest dart. Two documents agree in a coordinate with the probability of their weighted Jaccard similarity, and the
work is the number of shingles plus the number of darts, not their product.

Stages: equal texts are one node each, named by the hash of the text; `BANDS` bands of `ROWS` coordinates give buckets
(a pair of similarity 0.8 shares none of them with probability 7e-6);
  1. all members of a bucket are compared with its least one, unless fewer than `AGREEING` of their coordinates agree,
     five deviations below what the similarity gives; groups are the connected components of the links;
  2. buckets that still hold several groups are cut into tiles of about `TILE` shingles, and each pair of tiles is one
     unit of work: its members meet inside the task, only those of different groups and of like size are compared, and
     only a spanning forest of the links comes out. No row stands for a pair, and a unit is bounded by its two tiles.
Every pair of a bucket that could join two groups is compared exactly, by the weighted Jaccard similarity of the
shingles, and linked from `SIMILARITY` on. Classes are connected components.

Null texts count as empty; texts without a word have no shingle and are in a class only with equal texts. Rows with a
null id are left out, as they cannot be named. The texts of a repeated id are nodes of their own: `grouped` links their
classes, as it names classes by ids, `kept` does not. Different texts with one 64-bit hash would count as linked. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch, arrow, connected_components
from carelake.llm.kernels import U64, mix, occurrence, pieces, shingles, words
from carelake.operators.joins import join_summary

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 30
ROWS = 5
AGREEING = 0.64

#: Shingles of a tile, on average; a longer text is in a tile of its own size.
TILE = 1 << 20

_STEP = U64(0x9E3779B97F4A7C15)
_SIDE = U64(0xD6E8FEB86659FD93)
_NONE = U64(0xFFFFFFFFFFFFFFFF)


def _exponential(bits: np.ndarray) -> np.ndarray:
    return -np.log(((bits >> U64(11)) + U64(1)).astype(np.float64) * 2.0**-53)


def darts(strips: np.ndarray, theta: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(strip, rank, hash) of the darts below each strip's `theta`, in runs."""
    alive, rank, nth = np.arange(len(strips)), np.zeros(len(strips)), 0
    while len(alive):
        left = theta[alive] - rank
        wide = int(min(64, max(1, 2 * np.median(left))))
        for lo in range(0, len(alive), max(1, (1 << 20) // wide)):
            here = slice(lo, lo + max(1, (1 << 20) // wide))
            step = np.arange(nth + 1, nth + wide + 1).astype(U64) * _STEP
            hashed = mix(strips[alive[here], None] + step)
            ranks = rank[here, None] + np.cumsum(_exponential(hashed), axis=1)
            row, col = np.nonzero(ranks < theta[alive[here], None])
            yield alive[here][row], ranks[row, col], mix(hashed[row, col] ^ _SIDE)
            rank[here] = ranks[:, -1]
        on = rank < theta[alive]
        alive, rank, nth = alive[on], rank[on], nth + wide


def units(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A name for every unit of weight: equal shingles of a text differ by their number."""
    return mix(values + occurrence(values, doc).astype(U64) * _STEP)


def signatures(values: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """(texts x k) earliest darts; a text without a shingle has zeros."""
    n = len(offsets) - 1
    counts = np.diff(offsets)
    doc = np.repeat(np.arange(n), counts)
    strips = units(values, doc)
    best = np.full(n * k, _NONE, U64)
    enough = k * (np.log(k) + 4)
    theta = enough / np.maximum(counts, 1)
    todo = counts > 0
    while todo.any():
        own = todo[doc]
        strip, owner = strips[own], doc[own]
        for at, rank, hashed in darts(strip, theta[owner]):
            place = owner[at] * k + (hashed % U64(k)).astype(np.int64)
            packed = rank.astype(np.float32).view(np.uint32).astype(U64) << U64(32) | hashed >> U64(32)
            np.minimum.at(best, place, packed)
        todo &= (best.reshape(n, k) == _NONE).any(1)
        theta = np.where(todo, theta * 2, theta)
    out = best.reshape(n, k) & U64(0xFFFFFFFF)
    out[counts == 0] = 0
    return out


def bands(signature: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """(texts x bands) bucket numbers."""
    powers = np.cumprod(np.full(rows, _STEP, U64))
    mixed = (mix(signature.reshape(len(signature), n_bands, rows) + U64(1)) * powers).sum(2, dtype=U64)
    return mix(mixed + mix(np.arange(n_bands).astype(U64) + U64(7))).view(np.int64)


def sketched(docs: DataFrame, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`doc_id`, `node`, `proof` (two 64-bit hashes of the text) and `darts`; null for a text without a word."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in pieces(batch, "text", 4 << 20):
                w = words(run.column("text"))
                values, offsets = shingles(w, SHINGLE)
                kept_darts = signatures(values, offsets, n_bands * rows).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [run.column("doc_id"), run.column("node"), run.column("proof"),
                     pa.array([d.tobytes() if n else None for d, n in zip(kept_darts, w.counts, strict=True)], pa.binary())],
                    names=["doc_id", "node", "proof", "darts"])

    text = _text()
    rows_in = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        _node().alias("node"), F.xxhash64(F.lit("b"), text).alias("proof"))
    return arrow(rows_in, sketch, "doc_id long, node long, proof long, darts binary")


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _node() -> Column:
    return F.xxhash64(_text())


def banded(sketches: DataFrame, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """`node` and `bucket`, a row for each band."""

    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in pieces(batch, "darts", 1 << 20):
                kept_darts = np.frombuffer(b"".join(run.column("darts").to_pylist()), "<u4").reshape(-1, n_bands * rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(run.column("node").to_numpy(), n_bands)),
                    pa.array(bands(kept_darts.astype(U64), n_bands, rows).ravel())], names=["node", "bucket"])

    return arrow(sketches.where("darts is not null").select("node", "darts"), band, "node long, bucket long")


def weighed(texts: DataFrame) -> DataFrame:
    """`node`, `darts` and in place of `text` the sorted names of its `units`, with their number `n`."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in pieces(batch, "text", 1 << 20):
                values, offsets = shingles(words(run.column("text")), SHINGLE)
                named = units(values, np.repeat(np.arange(run.num_rows), np.diff(offsets)))
                parts = [np.sort(named[lo:hi]).tobytes() for lo, hi in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [run.column("node"), run.column("darts"), pa.array(parts, pa.binary()), pa.array(np.diff(offsets))],
                    names=["node", "darts", "units", "n"])

    return arrow(texts.select("node", "darts", "text"), weigh, "node long, darts binary, units binary, n long")


def similar(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (`a`, `b`) that agree in enough coordinates and have a similarity of `least` or more."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                darts_a, darts_b, of_a, of_b = (
                    np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                    for c, kind in (("darts_of_a", "<u4"), ("darts_of_b", "<u4"), ("units_of_a", U64), ("units_of_b", U64)))
                if (darts_a == darts_b).mean() < AGREEING * least / SIMILARITY:
                    continue
                both = len(np.intersect1d(of_a, of_b, assume_unique=True))
                if both / (len(of_a) + len(of_b) - both) >= least:
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    left, right = (texts.select(F.col("node").alias(s), F.col("units").alias(f"units_of_{s}"),
                                F.col("darts").alias(f"darts_of_{s}")) for s in ("a", "b"))
    both = pairs.join(right, "b").join(left, "a").select(
        "a", "b", "units_of_a", "units_of_b", "darts_of_a", "darts_of_b")
    return arrow(both, check, "a long, b long")


def forest(group: np.ndarray, tile: np.ndarray, units_of: list[np.ndarray], i: int, j: int,
           least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Places of links between tiles `i` and `j` (inside the tile, if they are one) that join the groups as all would."""
    size = np.array([len(u) for u in units_of])
    by_size = np.argsort(size, kind="stable")
    left, right = by_size[tile[by_size] == i], by_size[tile[by_size] == j]
    label = np.unique(group, return_inverse=True)[1]
    if not len(left) or not len(right) or not label.any():
        return []
    named, flat = np.unique(np.concatenate(units_of), return_inverse=True)
    at = np.concatenate(([0], np.cumsum(size)))
    of = [flat[lo:hi] for lo, hi in zip(at[:-1], at[1:], strict=True)]
    mark = np.zeros(len(named), np.int32)
    sizes = size[right]
    links = []
    for nth, a in enumerate(left):
        lo = int(np.searchsorted(sizes, size[a] * least * (1 - 1e-9)))
        hi = int(np.searchsorted(sizes, size[a] / least * (1 + 1e-9), "right"))
        others = right[max(lo, nth + 1) if i == j else lo: hi]
        others = others[label[others] != label[a]]
        if not len(others):
            continue
        mark[of[a]] = 1
        begin = np.cumsum(size[others]) - size[others]
        both = np.add.reduceat(mark[np.concatenate([of[b] for b in others])], begin)
        mark[of[a]] = 0
        for b in others[both / (size[a] + size[others] - both) >= least]:
            if label[a] != label[b]:
                links.append((a, b))
                label[label == label[b]] = label[a]
    return links


def joined(members: DataFrame, texts: DataFrame, least: float = SIMILARITY, tile: int = TILE) -> DataFrame:
    """Links (`a`, `b`) between the members (`bucket`, `node`, `g`) of a bucket that join its groups `g`."""
    members = members.join(texts.select("node", "n"), "node")
    totals = members.groupBy("bucket").agg(F.ceil(F.sum("n") / tile).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("node", F.lit("tile")), F.col("tiles")).cast("int")
    tiled = join_summary(members, totals, ["bucket"], "inner").withColumn("tile", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.select("bucket", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "node", "g")
    dealt = tiled.join(texts.select("node", "units"), "node").repartition("bucket", "i", "j")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def unit() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            node = rows.column("node").to_numpy()
            of = [np.frombuffer(u.as_buffer(), U64) for u in rows.column("units")]
            links = forest(rows.column("g").to_numpy(), rows.column("tile").to_numpy(), of,
                           rows.column("i")[0].as_py(), rows.column("j")[0].as_py(), least)
            ends = np.array(links, np.int64).reshape(-1, 2)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(node[ends[:, 0]]), pa.array(node[ends[:, 1]])], names=["a", "b"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("bucket", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if held and last != tuple(key[lo]):
                    yield unit()
                last = tuple(key[lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield unit()

    return arrow(dealt.sortWithinPartitions("bucket", "i", "j"), work, "a long, b long")


def linked(docs: DataFrame, scratch: Scratch, n_bands: int = BANDS, rows: int = ROWS,
           least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Every document's `doc_id`, `node` and `copy_of` (least id with its text), and links (`a`, `b`) between nodes."""
    sketches = scratch.keep(sketched(docs, n_bands, rows), "sketches")
    classes = sketches.groupBy("node", "proof").agg(F.min("doc_id").alias("copy_of"))
    member = scratch.keep(join_summary(sketches.select("doc_id", "node", "proof"), classes, ["node", "proof"], "inner")
                          .select("doc_id", "node", "copy_of"), "members")
    # Sketches of equal texts are equal, so it is enough to keep those of the documents that stand for their text.
    first_of = sketches.join(
        classes.select(F.col("copy_of").alias("doc_id"), "node", "proof"), ["doc_id", "node", "proof"], "left_semi")
    entries = banded(first_of, n_bands, rows)
    shared = entries.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    # Kept apart, so that both sides of the join are plain exchanges, of which a hot partition can be split.
    shared = scratch.keep(shared.where("first <> last").select("bucket", "first"), "shared")
    inside = scratch.keep(entries.join(shared, "bucket").select("bucket", "node", "first"), "buckets")
    wanted = inside.select("node").distinct()
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text().alias("text"), _node().alias("node"))
    known = first_of.join(wanted, "node", "left_semi").dropDuplicates(["node"]).select("doc_id", "node", "darts")
    texts = scratch.keep(weighed(named.join(known, ["doc_id", "node"]).dropDuplicates(["node"])), "texts")
    scratch.drop("sketches")
    pairs = inside.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    links = scratch.keep(similar(pairs, texts, least), "links-1")
    of = connected_components(links, scratch, "groups-1").select("node", F.col("component").alias("g"))
    now = inside.join(of, "node", "left").select("bucket", "node", F.coalesce("g", "node").alias("g"))
    now = scratch.keep(now, "grouped")
    open_ = now.groupBy("bucket").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo <> hi").select("bucket")
    links = scratch.keep(joined(join_summary(now, open_, ["bucket"], "inner"), texts, least).union(links), "links")
    scratch.drop("texts", "buckets", "grouped")
    return member, links


def grouped(docs: DataFrame, scratch: Scratch, n_bands: int = BANDS, rows: int = ROWS,
            least: float = SIMILARITY) -> DataFrame:
    """Every document with `class_id` (least id of its group of near copies) and `copy_of` (least id with its text)."""
    member, links = linked(docs, scratch, n_bands, rows, least)
    # A repeated id holds the classes of its texts together.
    again = member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    again = member.join(again.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b")).distinct()
    of = connected_components(links.union(again), scratch, "groups-2")
    texts = member.groupBy("node").agg(F.min("copy_of").alias("copy_of"))
    least_of = texts.join(of, "node").groupBy("component").agg(F.min("copy_of").alias("class_id"))
    classes = scratch.keep(of.join(least_of, "component").select("node", "class_id"), "classes")
    return join_summary(member, classes, ["node"]).select(
        "doc_id", F.coalesce("class_id", "copy_of").alias("class_id"), "copy_of").dropDuplicates()


def kept(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row of each group of near copies, that of the least id (then the least hash of the text); rows with a null
    id stay. A repeated id keeps a row for each of its texts that leads a group."""
    member, links = linked(docs, scratch)
    of = connected_components(links, scratch, "groups-2")
    texts = member.groupBy("node").agg(F.min("copy_of").alias("copy_of"))
    first = texts.join(of, "node").groupBy("component").agg(F.min(F.struct("copy_of", "node")).alias("o"))
    gone = of.join(first.select(F.col("o.node").alias("node")), "node", "left_anti").select("node")
    stays = scratch.keep(texts.join(gone, "node", "left_anti").select(F.col("copy_of").alias("_id"), F.col("node").alias("_of")), "stays")
    mine, text = F.col("doc_id").cast("long"), "hash of the text"
    rows = docs.where("doc_id is not null").withColumn(text, _node())
    rows = rows.join(stays, (mine == F.col("_id")) & (F.col(text) == F.col("_of")), "left_semi").dropDuplicates(["doc_id", text])
    return rows.select(*docs.columns).unionByName(docs.where("doc_id is null"))
