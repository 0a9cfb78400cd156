"""Passages that occur in several documents, by a sparse suffix array over words.

1. Sparse suffixes. A suffix is kept where the hash of its first five words is the least of some run of `RUN`
   neighbouring suffixes. Any passage of `LEAST` words holds such a run whole, so two documents that share the passage
   keep suffixes at the same places of it, each with `KEY` = LEAST - RUN + 1 words of the passage to its right.
2. Sort and compare. Suffixes are range-sorted by the fingerprint of their first KEY words (then by text, so that a
   suffix that a third of all documents share is spread over many tasks); a suffix that agrees with neither neighbour is
   dropped. What agrees with a suffix of a different text is a match.
3. Extend. A match grows to the left and right to windows of LEAST words around it; windows that different texts share
   stay, and overlapping ones join into maximal spans.

Equal texts are handled once: every one of several equal texts of LEAST words or more is one span from end to end.
The answer has a row per span: document, first word, end, number of words, and another document that has its start.
Documents without a shared passage have no row. Null, empty and short texts share none; rows with a null id are left
out, as they cannot be named. Repeated rows are equal texts if they have different ids and one document otherwise.
Other columns are not read. Fingerprints have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import Scratch, arrow
from carelake.llm.kernels import U64, Words, mix, pieces, shingles, words

LEAST = 50
RUN = 20
SEED = 5

_B = U64(0x9E3779B97F4A7C15)
_B_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Prints:
    """Fingerprints of any run of words of a batch, from one running sum."""

    def __init__(self, w: Words) -> None:
        n = len(w.hashes)
        powers = np.cumprod(np.concatenate((np.ones(1, U64), np.full(max(n - 1, 0), _B, U64))))[:n]
        self.sums = np.concatenate((np.zeros(1, U64), np.cumsum(w.hashes * powers, dtype=U64)))
        self.back = np.cumprod(np.concatenate((np.ones(1, U64), np.full(max(n - 1, 0), _B_INVERSE, U64))))[:n]

    def of(self, start: np.ndarray, length: int) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.back[start] + U64(length)).view(np.int64)


def chosen(w: Words, least: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in the batch's words) of the suffixes to keep."""
    key = least - run + 1
    places = np.maximum(w.counts - key + 1, 0)
    places[w.counts < least] = 0
    doc = np.repeat(np.arange(len(places)), places)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(places) - places, places) + np.repeat(w.of[:-1], places)
    if not len(at):
        return doc, at
    # Every kept place has SEED words to its right, so its shingle is the one of that number in its text.
    values, offsets = shingles(w, SEED)
    rank = values[at - np.repeat(w.of[:-1], places) + np.repeat(offsets[:-1], places)]
    n, low, width = len(rank), rank, 1
    while width * 2 <= run:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < run:
        low = np.minimum(low[: n - run + 1], low[run - width: run - width + n - run + 1])
    low = np.where(doc[: n - run + 1] == doc[run - 1:], low, U64(0))  # a run of one text only
    padded = np.concatenate((np.zeros(run - 1, U64), low, np.zeros(run - 1, U64)))
    high, width = padded, 1
    while width * 2 <= run:
        high = np.maximum(high[:-width], high[width:])
        width *= 2
    high = np.maximum(high[:n], high[run - width: run - width + n])
    keep = high == rank
    return doc[keep], at[keep]


def sampled_suffixes(docs: DataFrame, least: int, run: int) -> DataFrame:
    """`key`, `text_a`, `doc_id`, `at` (word number) of the kept suffixes."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in pieces(batch, "text", 4 << 20):
                w = words(rows.column("text"))
                doc, at = chosen(w, least, run)
                keys = Prints(w).of(at, least - run + 1)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys), rows.column("text_a").take(pa.array(doc)), rows.column("doc_id").take(pa.array(doc)),
                    pa.array((at - w.of[doc]).astype(np.int32))], names=["key", "text_a", "doc_id", "at"])

    return arrow(docs.select("doc_id", "text", "text_a"), sample, "key long, text_a long, doc_id long, at int")


def agreeing(suffixes: DataFrame) -> DataFrame:
    """Sorted suffixes that agree with a neighbour; the ends of a partition, whose neighbour is elsewhere, stay."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.concat_batches([last, batch])
            keys = batch.column("key").to_numpy()
            same = keys[1:] == keys[:-1]
            left = np.concatenate(([before is None or before == keys[0]], same))
            right = np.concatenate((same, [False]))
            keep = (left | right)[:-1]
            yield batch.slice(0, batch.num_rows - 1).filter(pa.array(keep))
            if batch.num_rows > 1:
                before = keys[-2]
            last = batch.slice(batch.num_rows - 1)
        if last is not None:
            yield last

    ordered = suffixes.repartitionByRange("key", "text_a", "doc_id", "at").sortWithinPartitions("key", "text_a", "doc_id", "at")
    return arrow(ordered, compare, "key long, text_a long, doc_id long, at int")


def windows(matches: DataFrame, docs: DataFrame, least: int, run: int) -> DataFrame:
    """`print`, `doc_id`, `start` of the windows of `least` words around the matches of a text."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in pieces(batch, "text", 4 << 20):
                w = words(rows.column("text"))
                prints = Prints(w)
                found = rows.column("places")
                seeds = found.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(rows.num_rows), np.diff(found.offsets.to_numpy()))
                start = seeds[:, None] - np.arange(run)
                inside = (start >= 0) & (start + least <= w.counts[doc][:, None])
                owner, nth = np.nonzero(inside)
                at = np.unique(w.of[doc[owner]] + start[owner, nth])
                doc = np.searchsorted(w.of, at, "right") - 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(prints.of(at, least)), rows.column("doc_id").take(pa.array(doc)),
                    pa.array((at - w.of[doc]).astype(np.int32))], names=["print", "doc_id", "start"])

    texts = docs.select("doc_id", "text").dropDuplicates(["doc_id"])
    rows = matches.join(texts, "doc_id").select("doc_id", "text", "places")
    return arrow(rows, extend, "print long, doc_id long, start int")


def spans(starts: DataFrame, least: int) -> DataFrame:
    """Joins overlapping windows (`doc_id`, `start`, `other`) of a document."""
    rows = starts.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "other"))).alias("w"))
    joined = F.expr(
        "aggregate(w, cast(array() as array<struct<a: int, b: int, other: bigint>>), (s, x) -> "
        f"if(size(s) > 0 and element_at(s, -1).b >= x.start, concat(slice(s, 1, size(s) - 1), array(named_struct("
        f"'a', element_at(s, -1).a, 'b', x.start + {least}, 'other', element_at(s, -1).other))), "
        f"concat(s, array(named_struct('a', x.start, 'b', x.start + {least}, 'other', x.other)))))")
    return rows.select("doc_id", F.explode(joined).alias("s")).select(
        "doc_id", F.col("s.a").alias("first_word"), F.col("s.b").alias("end_word"), F.col("s.other").alias("other_doc"))


def shared_passages(docs: DataFrame, scratch: Scratch, least: int = LEAST, run: int = RUN) -> DataFrame:
    """`doc_id`, `first_word`, `end_word`, `n_words`, `other_doc` of every passage that other texts have too."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_a"))
    suffixes = scratch.keep(sampled_suffixes(rows, least, run), "suffixes")
    near = scratch.keep(agreeing(suffixes), "agreeing")
    scratch.drop("suffixes")
    # Kept apart, so that both sides of the join are plain exchanges, of which a hot partition can be split.
    twice = near.groupBy("key").agg(F.min("text_a").alias("lo"), F.max("text_a").alias("hi")).where("lo <> hi")
    twice = scratch.keep(twice.select("key"), "keys")
    matches = near.join(twice, "key", "left_semi").groupBy("text_a").agg(
        F.min("doc_id").alias("doc_id"), F.collect_set("at").alias("places"))
    found = scratch.keep(windows(matches, rows, least, run), "windows")
    common = found.groupBy("print").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo <> hi")
    common = scratch.keep(common, "prints")
    starts = found.join(common, "print").select(
        "doc_id", "start", F.when(F.col("lo") == F.col("doc_id"), F.col("hi")).otherwise(F.col("lo")).alias("other"))
    passages = scratch.keep(spans(starts, least), "spans")
    scratch.drop("agreeing", "windows")
    # Equal texts: all of them get the passages of the one that stood for them, or are one passage from end to end.
    n_words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    long_ = scratch.keep(rows.select("doc_id", "text_a", n_words.alias("n")).where(F.col("n") >= least), "texts")
    same = long_.groupBy("text_a").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    whole = long_.join(same.where("lo <> hi"), "text_a").select(
        "doc_id", F.lit(0).alias("first_word"), F.col("n").alias("end_word"),
        F.when(F.col("lo") == F.col("doc_id"), F.col("hi")).otherwise(F.col("lo")).alias("other_doc")).distinct()
    alone = passages.join(long_.join(same.where("lo <> hi"), "text_a", "left_semi").select("doc_id"), "doc_id", "left_anti")
    return whole.unionByName(alone).select(
        "doc_id", "first_word", "end_word", (F.col("end_word") - F.col("first_word")).alias("n_words"), "other_doc")
