"""A mix of sources with a curriculum: which words of a document are read, how often, and at which point of the run.

1. Shares: every source has a base weight; a source that would need more than `epochs` passes stops there and the rest
   is shared again by weight, until no source is above its limit.
2. Order inside a source: by the MD5 digest of the id, the same in every run. A running sum of the words gives each
   document its stretch of the source's demand; the sum is taken per prefix of the digest, whose totals are added up in a
   small table, so that no task holds a whole source.
3. Curriculum: a source's weight moves linearly from `base * (1 - slope)` to `base * (1 + slope)` over the run. Its
   integral, scaled to the source's target, is the demand up to time t; the inverse of it at a document's stretch is the
   document's position in training. `training_order` and `repeated` sort by position with a range partitioning; `digest`
   returns the position at which a document is first read, and its rank among the documents by it.

Null and empty texts have size 0 and are taken 0 words. The null source is a source of its own, after all others.
Repeated rows are documents of their own; rows equal in id and text are interchangeable. The last document of a source
that is needed is cut at the target, so taken words add up to the whole part of the target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import GAP, Scratch

#: Base weights, repeated over the sources in code point order.
WEIGHTS = (5, 2, 1)

#: A source is read at most so many times.
EPOCHS = 3

#: Change of a source's weight over the run, repeated over the sources in the same order.
SLOPES = (-0.5, 0.0, 0.5)

#: Documents whose running sum one task takes, about.
ROWS_PER_SUM = 4_000


def _bare(text: Column) -> Column:
    """Without gap characters around; a null is empty."""
    return F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))


def sized(docs: DataFrame) -> DataFrame:
    text = _bare(F.col("text"))
    size = F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, GAP))).cast("long")
    return docs.select(
        "doc_id", "source", size.alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("place"),
        F.xxhash64(text).alias("tie"))


def shares(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """From (source, n_docs, source_size): target and the weight schedule of every source.

    One row per source; the windows run over those rows only. Sources that reach their limit are the ones with the
    least limit per weight: a source is among them if the level without it would be above its own limit.
    """
    alone = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(alone) - 1)
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (place % len(values) + 1).cast("int"))
    rows = sizes.select("*", pick([float(w) for w in weights]).alias("w"), pick(SLOPES).alias("slope"))
    rows = rows.withColumn("limit", F.col("source_size") * float(epochs))
    by_limit = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.select(
        "*", F.sum("source_size").over(everything).cast("double").alias("total"),
        F.coalesce(F.sum("limit").over(before), F.lit(0.0)).alias("spent"), F.sum("w").over(onward).alias("open"))
    rows = rows.withColumn("full", (F.col("total") - F.col("spent")) * F.col("w") >= F.col("limit") * F.col("open"))
    rows = rows.select(
        "*", F.coalesce(F.sum(F.when(F.col("full"), F.col("limit"))).over(everything), F.lit(0.0)).alias("taken_full"),
        F.sum(F.when(~F.col("full"), F.col("w"))).over(everything).alias("open_w"))
    target = F.when(F.col("full"), F.col("limit")).otherwise(
        (F.col("total") - F.col("taken_full")) / F.col("open_w") * F.col("w"))
    return rows.select("source", "n_docs", "source_size", target.alias("target"), "w", "slope")


def curriculum(docs: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """Per document: size, its source's size and target, and `reads`: (epoch, words, position) of each time it is read."""
    rows = scratch.keep(sized(docs), "sizes")
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    plan = scratch.keep(shares(sizes, weights, epochs), "shares")
    largest = plan.agg(F.max("n_docs")).first()[0] or 0
    digits = max(0, math.ceil(math.log(max(largest, 1) / ROWS_PER_SUM, 16)))
    rows = rows.withColumn("part", F.substring("place", 1, digits))
    inside = (Window.partitionBy("source", "part").orderBy("place", F.col("doc_id").asc_nulls_first(), "tie")
              .rowsBetween(Window.unboundedPreceding, -1))
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("ahead"))
    plan = plan.alias("p").join(sums.alias("s"), F.expr("p.source <=> s.source")).select("p.*", "part", "ahead")
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source and d.part = p.part")).select(
        "d.doc_id", "d.source", "d.tie", "d.size", "p.source_size", "p.target", "p.w", "p.slope",
        (F.col("d.inside") + F.col("p.ahead")).alias("start"))
    quota = F.floor("target").cast("long")
    reads = []
    for epoch in range(epochs):
        at = F.col("start") + F.lit(epoch) * F.col("source_size")
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), quota - at))
        reads.append(F.struct(F.lit(epoch).alias("epoch"), words.alias("words"), _time(at, words).alias("position")))
    return placed.select("doc_id", "source", "tie", "size", "source_size", "target",
                         F.filter(F.array(*reads), lambda r: r["words"] > 0).alias("reads"))


def _time(at, words):
    """Time in [0, 1] at which the source's demand reaches the middle of a document: the inverse of a quadratic.

    With weights w0 -> w1 the demand up to t, as a share, is (w0 t + (w1 - w0) t^2 / 2) / ((w0 + w1) / 2).
    """
    share = (at + words / 2) / F.col("target")
    w0, w1 = F.col("w") * (1 - F.col("slope")), F.col("w") * (1 + F.col("slope"))
    y = share * (w0 + w1)
    # the form without a difference of near values; it holds for a constant weight as well
    return F.when(F.col("target") > 0, y / (w0 + F.sqrt(w0 * w0 + (w1 - w0) * y)))


#: Order of the readings over the whole run.
ORDER = ("position", "source", "doc_id", "epoch")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per reading of a document, sorted by position over all partitions."""
    reads = mixed.select("doc_id", "source", F.explode("reads").alias("r")).select("doc_id", "source", "r.*")
    return reads.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)


def repeated(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of `docs` as often as they are read, in training order over all partitions; a reading that is cut has
    the first words, joined by one space.

    Rows equal in id, source and text are one row with the readings of all of them.
    """
    key = ["doc_id", "source", "tie"]
    reads = mixed.select(*key, "size", F.explode("reads").alias("r")).select(
        *key, "r.position", "r.epoch", F.when(F.col("r.words") < F.col("size"), F.col("r.words")).alias("cut"))
    rows = docs.withColumn("tie", F.xxhash64(_bare(F.col("text")))).dropDuplicates(key)
    both = rows.alias("d").join(reads.alias("m"), F.expr("d.doc_id <=> m.doc_id and d.source <=> m.source and d.tie = m.tie"))
    both = both.select("d.*", "m.position", "m.epoch", "m.cut")
    words = F.array_join(F.slice(F.split(_bare(F.col("text")), GAP), F.lit(1), F.col("cut").cast("int")), " ")
    both = both.withColumn("text", F.when(F.col("cut").isNull(), F.col("text")).otherwise(words))
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.when(F.col("cut").isNull(), F.col("n_chars")).otherwise(F.length("text")))
    return both.repartitionByRange(*ORDER, "tie").sortWithinPartitions(*ORDER, "tie").select(*docs.columns)


def ranked(rows: DataFrame, scratch: Scratch, by: str, name: str) -> DataFrame:
    """Add `name`, the rank by the column `by` over the whole table, and null where `by` is null.

    Rows lie in ranges of `by`; a rank is that inside the range and the rows of the ranges before, which are added up in a
    small table. No task holds more than a range.
    """
    held = scratch.keep(rows.where(F.col(by).isNotNull()).repartitionByRange(by).withColumn("part", F.spark_partition_id()), name)
    totals = held.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    ahead = totals.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    inside = held.withColumn("inside", F.rank().over(Window.partitionBy("part").orderBy(by)))
    whole = inside.join(F.broadcast(ahead), "part").select(*rows.columns, (F.col("inside") + F.col("ahead")).alias(name))
    return whole.unionByName(rows.where(F.col(by).isNull()).withColumn(name, F.lit(None).cast("long")))


def digest(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Per document how many of its words are taken, at which position of the run it is first read, and as which document.

    The first reading has the least position. A document that is not read has neither position nor rank.
    """
    taken = F.expr("aggregate(reads, 0L, (a, r) -> a + r.words)")
    mixed = curriculum(docs, scratch).select("doc_id", "size", "source_size", "target", taken.alias("taken"),
                                             F.get("reads", F.lit(0))["position"].alias("first_position"))
    return ranked(scratch.keep(mixed, "mixed"), scratch, "first_position", "first_rank")


#: The same by SQL: one running sum per source.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS place FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
         ([-0.5, 0.0, 0.5])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS slope
  FROM d GROUP BY source),
l AS (
  SELECT *, source_size * 3.0::DOUBLE AS lim, sum(source_size) OVER ()::DOUBLE AS total FROM s),
o AS (
  SELECT *, coalesce(sum(lim) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
         sum(w) OVER (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM l),
f AS (SELECT *, (total - spent) * w >= lim * open AS is_full FROM o),
t AS (
  SELECT source, source_size, w, slope, CASE WHEN is_full THEN lim ELSE
           (total - coalesce(sum(lim) FILTER (is_full) OVER (), 0)) / sum(w) FILTER (NOT is_full) OVER () * w END AS target
  FROM f),
p AS (
  SELECT doc_id, d.source, size, source_size, target, floor(target)::BIGINT AS quota, w * (1 - slope) AS w0, w * (1 + slope) AS w1,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (
  SELECT doc_id, size, source_size, target,
         (greatest(0, least(size, quota - start)) + greatest(0, least(size, quota - start - source_size))
          + greatest(0, least(size, quota - start - 2 * source_size)))::BIGINT AS taken, w0, w1,
         CASE WHEN least(size, quota - start) > 0 THEN (start + least(size, quota - start) / 2::DOUBLE) / target * (w0 + w1) END AS y
  FROM p),
f1 AS (
  SELECT doc_id, size, source_size, target, taken, y / (w0 + sqrt(w0 * w0 + (w1 - w0) * y)) AS first_position FROM r)
SELECT *, CASE WHEN first_position IS NOT NULL THEN rank() OVER (ORDER BY first_position NULLS LAST) END AS first_rank
FROM f1
"""
