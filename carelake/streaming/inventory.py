"""Pharmacy change stream: cheap micro-batches, merge when the table is read or compacted.

A batch only appends its own parsed changes, so its cost follows the batch and not the table. The current
table is the compacted one merged with the changes landed since; `compact` folds them in, and rewrites only the
buckets whose keys have changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators.cdc import merge_changes
from carelake.sources import buckets, schemas
from carelake.sources.readers import read_or_empty
from carelake.streaming import parse
from carelake.streaming.runtime import write_batch

KEY = "inventory_id"
COLUMNS = [c for c in schemas.INVENTORY_ROW.fieldNames() if c != KEY]

_CHANGE_SCHEMA = T.StructType([
    *schemas.INVENTORY_ROW.fields,
    T.StructField("op", T.StringType()), T.StructField("txn_id", T.StringType()),
    T.StructField("ts_ms", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("kafka_timestamp", T.TimestampType()), T.StructField("query_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
_TABLE_SCHEMA = T.StructType([*schemas.INVENTORY_ROW.fields, T.StructField("_is_deleted", T.BooleanType())])


def land_batch(root: str) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function: inventory changes and dispensing inserts of the batch."""

    def process(batch: DataFrame, batch_id: int) -> None:
        events = parse.changes(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(parse.inventory_changes(events), f"{root}/changes", batch_id)
            write_batch(parse.dispensing_inserts(events), f"{root}/dispensing", batch_id)
        finally:
            events.unpersist()

    return process


def _base(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/inventory"
    if not buckets.exists(spark, path):
        return spark.createDataFrame([], _TABLE_SCHEMA)
    return buckets.read(spark, path)


def _fresh(spark: SparkSession, root: str) -> DataFrame:
    """Changes that no compaction has folded in: of every query, those after the last batch it was asked for."""
    landed = read_or_empty(spark, f"{root}/changes", _CHANGE_SCHEMA)
    if not buckets.exists(spark, f"{root}/inventory"):
        return landed
    # A mark for every query, of which there is one per checkpoint.
    marks = buckets.loads(spark, f"{root}/inventory").select(F.explode("notes").alias("query_id", "mark")).groupBy("query_id").agg(
        F.max(F.col("mark").cast("long")).alias("mark"))
    known = landed.join(F.broadcast(marks), "query_id", "left")
    return known.where(F.col("batch_id") > F.coalesce("mark", F.lit(-1))).drop("mark")


def current_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Inventory as of the last landed batch; deleted rows carry `_is_deleted`."""
    return merge_changes(_base(spark, root), _fresh(spark, root), KEY, COLUMNS)


def compact(spark: SparkSession, root: str) -> list[int]:
    """Fold the landed changes into the table; returns the buckets that were rewritten. Run it between streaming runs.

    The log of loads remembers the last batch of every query.
    """
    path = f"{root}/inventory"
    if not buckets.exists(spark, path):
        buckets.create(spark.createDataFrame([], _TABLE_SCHEMA), path, KEY)
    fresh = _fresh(spark, root)
    last = {r["query_id"]: str(r["last"]) for r in fresh.groupBy("query_id").agg(F.max("batch_id").alias("last")).collect()}
    number = buckets.loads(spark, path).count()
    return buckets.merge(path, fresh, f"{number:06d}", lambda now, changes: merge_changes(
        now, changes, KEY, COLUMNS), notes=last)


def critical_stock(inventory: DataFrame) -> DataFrame:
    return inventory.filter(F.col("is_critical") & ~F.col("_is_deleted"))
