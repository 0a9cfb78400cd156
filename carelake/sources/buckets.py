"""Tables that are published by bucket: a load rewrites the buckets whose keys it changes, and nothing else.

Rows lie in partitions of a hash bucket of their key and a state: `current`, or `closed-<load>` for versions that this load
has closed. A load reads the current rows of the buckets its keys fall into, writes what it closes to partitions of its own,
and then replaces the current partitions of these buckets by Spark's dynamic partition overwrite. Closed history and all
other buckets keep their files.

A load has an id. One that failed is run again under the same id before the next: what it had closed is written
to the same partitions, buckets it had replaced see no change any more, and its entry in the log of loads comes last.
The number of buckets is fixed when the table is made: about one for every gigabyte the table may come to hold.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators.joins import settled

BUCKETS = 64
BUCKET, STATE, CURRENT = "_bucket", "_state", "current"
# Folders that begin with an underscore are no part of the data to Spark's readers.
LAYOUT, LOADS = "_layout", "_loads"
_LOAD_SCHEMA = "load_id string, closed long, current long, buckets int, notes map<string,string>"


def _bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _store(df: DataFrame, path: str, mode: str) -> None:
    """Rows of a bucket come from one task, unless the bucket is too large for one."""
    df.hint("rebalance", F.col(BUCKET)).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
        BUCKET, STATE).parquet(path)


def create(df: DataFrame, path: str, key: str, buckets: int = BUCKETS, closed: Column | None = None) -> None:
    """A new table with the rows of `df`; rows for which `closed` holds are history. Fails if there is one."""
    spark = df.sparkSession
    layout = [(key, buckets, df.schema.json())]
    spark.createDataFrame(layout, "key string, buckets int, fields string").coalesce(1).write.mode("errorifexists").parquet(f"{path}/{LAYOUT}")
    state = F.lit(CURRENT) if closed is None else F.when(closed, "closed-0").otherwise(CURRENT)
    _store(df.withColumns({BUCKET: _bucket_of(F.col(key), buckets), STATE: state}), path, "append")


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(f"{path}/{LAYOUT}")
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _rows(spark: SparkSession, path: str) -> DataFrame:
    fields = T.StructType.fromJson(json.loads(spark.read.parquet(f"{path}/{LAYOUT}").first()["fields"])).fields
    return spark.read.schema(T.StructType([
        *fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(STATE, T.StringType())])).parquet(path)


def read(spark: SparkSession, path: str, current_only: bool = False) -> DataFrame:
    """All rows, or the current ones; the latter are found by partition, without reading history."""
    rows = _rows(spark, path)
    if current_only:
        rows = rows.where(F.col(STATE) == CURRENT)
    return rows.drop(BUCKET, STATE)


def loads(spark: SparkSession, path: str) -> DataFrame:
    """One row per finished load: `load_id`, rows `closed` and `current`, `buckets` rewritten, `notes`."""
    try:
        return spark.read.schema(_LOAD_SCHEMA).parquet(f"{path}/{LOADS}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOAD_SCHEMA)


def merge(path: str, delta: DataFrame, load_id: str, apply: Callable[[DataFrame, DataFrame], DataFrame],
          closed: Column | None = None, notes: Mapping[str, str] | None = None) -> list[int]:
    """Publish one load; returns the buckets it has rewritten.

    `apply` takes the current rows of the buckets that `delta` (it has the table's key) falls into and `delta`, and gives
    these rows anew; those for which `closed` holds leave the current rows for good.
    """
    spark = delta.sparkSession
    key, buckets, _ = spark.read.parquet(f"{path}/{LAYOUT}").first()
    # At most as many numbers as there are buckets.
    touched = sorted(r[0] for r in delta.select(_bucket_of(F.col(key), buckets)).distinct().collect())
    counts = (0, 0)
    if touched:
        now = _rows(spark, path).where(F.col(BUCKET).isin(touched) & (F.col(STATE) == CURRENT)).drop(BUCKET, STATE)
        ended = F.lit(False) if closed is None else F.coalesce(closed, F.lit(False))
        new = settled(apply(now, delta).withColumns({
            BUCKET: _bucket_of(F.col(key), buckets), STATE: F.when(ended, f"closed-{load_id}").otherwise(CURRENT)}))
        counts = new.agg(F.count_if(F.col(STATE) != CURRENT), F.count_if(F.col(STATE) == CURRENT)).first()
        if counts[0]:
            _store(new.where(F.col(STATE) != CURRENT), path, "overwrite")
        _store(new.where(F.col(STATE) == CURRENT), path, "overwrite")
    entry = [(load_id, counts[0], counts[1], len(touched), dict(notes or {}))]
    spark.createDataFrame(entry, _LOAD_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/{LOADS}")
    return touched
