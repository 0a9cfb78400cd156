"""Join shapes: size-checked broadcast, summaries joined back, point-in-time, range-exists, orphan checks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.dates import in_interval
from carelake.session import use_checkpoint_dir

BROADCAST_BYTES = 32 * 1024 * 1024


def plan_bytes(df: DataFrame) -> int:
    """Size of the result as the optimizer estimates it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small table written in code. Unlike `createDataFrame`, its size is known to the optimizer."""
    fields = T.StructType.fromDDL(schema).fields
    if not rows:
        return spark.createDataFrame([], T.StructType(fields))
    entries = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Replicate the dimension while its estimated size is below `limit`; shuffle both sides beyond it."""
    return fact.join(F.broadcast(dim) if plan_bytes(dim) <= limit else dim, on, how)


def join_summary(detail: DataFrame, summary: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows with an aggregate over the same keys (one row per key).

    The keys are compared as one struct. An aggregate already lies partitioned by its keys, and the adaptive
    skew split only applies when both sides of a join are shuffled for it; with the packed key they are, at
    the price of moving the summary once more. NULL keys meet their own group.
    """
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    other = summary.withColumnsRenamed(names)
    packed = F.struct(*[detail[k] for k in keys]) == F.struct(*[other[n] for n in names.values()])
    return detail.join(other, packed, how).drop(*names.values())


def settled(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """The rows written to the shared checkpoint folder and read back, so that their size is known.

    For results that are small by nature but whose size the optimizer cannot foresee, such as rule hits:
    `join_dimension` can then replicate them instead of shuffling the large side.
    """
    spark = df.sparkSession
    path = f"{use_checkpoint_dir(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def source_bytes(df: DataFrame) -> int:
    """Size of the tables that the rows are made from, as the optimizer estimates it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def reused(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows that several steps read: each makes them again while their tables are below `limit`, else they are written once.

    Joins that shuffle large tables are then made once instead of once per step. Select the columns that are needed before.
    """
    return settled(df, "zstd") if source_bytes(df) > limit else df


def changed_rows(incoming: DataFrame, current: DataFrame, key: str, new_hash: str, old_hash: str) -> DataFrame:
    """Incoming rows whose key exists with a different hash."""
    known = current.select(F.col(key), F.col(old_hash))
    return incoming.join(known, key, "inner").filter(F.col(new_hash) != F.col(old_hash))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent and how many rows carry them.

    The child is reduced to its keys before the join, so a hot key costs one row.
    """
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("child_rows"))
    return used.join(parent.select(key), key, "left_anti")


def as_of_versions(facts: DataFrame, versions: DataFrame, key: str, day: str, start: str = "eff_start_date",
                   end: str = "eff_end_date", how: str = "left", horizon: Column | None = None) -> DataFrame:
    """Attach to each fact the version valid on its day (`start <= day < end`).

    Both sides also meet on the calendar year, so a fact is compared with the versions of one year of its
    key only and the rows of a hot key spread over the years. A version is repeated once per year it
    covers; open versions end with the last fact. `horizon` is a day no fact exceeds; pass it where `facts`
    is costly to read a second time.
    """
    horizon = facts.agg(F.max(day)).scalar() if horizon is None else horizon
    covered = versions.withColumn("_last", F.least(F.coalesce(F.date_sub(F.col(end), 1), horizon), horizon))
    per_year = (
        covered.filter(F.col("_last") >= F.col(start))
        .withColumn("_year", F.explode(F.sequence(F.year(start), F.year("_last"))))
        .drop("_last")
        .withColumnRenamed(key, "_key")
    )
    left = facts.withColumn("_year", F.year(day))
    hit = [left[key] == per_year["_key"], left["_year"] == per_year["_year"],
           in_interval(left[day], per_year[start], per_year[end])]
    return left.join(per_year, hit, how).drop("_key", "_year")


def recent_event_flag(df: DataFrame, events: DataFrame, key: str, at: str, event_ts: str, seconds: int,
                      name: str) -> DataFrame:
    """1 where the key has an event with `0 <= at - event < seconds`, else 0. A NULL key has no events.

    Events are kept as distinct seconds per (key, time bucket of the interval's length), at most `2 * seconds`
    per bucket, so the lookup is an equi join that adds no rows.
    """
    unix = F.unix_seconds(F.col(event_ts).cast("timestamp"))
    bucket = F.floor(F.col("_e") / F.lit(seconds))
    known = (
        events.filter(F.col(event_ts).isNotNull() & F.col(key).isNotNull())
        .select(F.col(key), unix.alias("_e"))
        .withColumn("_bucket", F.explode(F.array(bucket, bucket + 1)))
        .groupBy(key, "_bucket")
        .agg(F.collect_set("_e").alias("_events"))
    )
    known = known.withColumnsRenamed({key: "_key"})
    timed = df.withColumn("_at", F.unix_seconds(F.col(at).cast("timestamp")))
    # As in `join_summary`; the bucket is part of the join condition alone, so that it is not shuffled as a column.
    same = F.struct(timed[key], F.floor(timed["_at"] / F.lit(seconds))) == F.struct(known["_key"], known["_bucket"])
    gap = F.exists("_events", lambda e: (F.col("_at") >= e) & (F.col("_at") - e < seconds))
    return (
        timed.join(known, same, "left")
        .withColumn(name, F.coalesce(gap, F.lit(False)).cast("int"))
        .drop("_at", "_key", "_bucket", "_events")
    )
