"""Stateful event pipeline: late events set aside, replays dropped, windows closed behind the watermark.

Spark's stateful operators drop events that are older than the watermark and only count them. Here nothing goes in
silence: a first query, the intake, compares every event with the newest event time of the batches before it, and writes
what is as old as the watermark, or has no event time, to the dead letters. It lands the rest, from which two more queries
run: one drops replays of a log position for as long as the watermark keeps them, and hands its batches on; the other
counts readings in windows and appends a window once the watermark has passed its end. Both see landed batches in order,
so their watermarks are never ahead of the intake's, and what it let pass is late for neither.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from carelake.operators.audit import audit_record
from carelake.sources.readers import read_or_empty
from carelake.streaming import windows
from carelake.streaming.runtime import QUERY_ID, start, with_trigger, write_batch

LATE = "Event older than the watermark"
UNTIMED = "Event without a readable event time"
#: A log position, which a replay delivers again.
POSITION = ("topic", "partition", "offset")

_MARK_SCHEMA = "newest timestamp, query_id string, batch_id long"


@dataclass
class EventSpec:
    """One stream: name, target folder, run, event time, and how far behind the newest event one may be."""

    name: str
    root: str
    run_id: str
    tolerance: str
    event_ts: str = "event_ts"

    def folder(self, kind: str) -> str:
        return f"{self.root}/{kind}/{self.name}"


def _mark(spark: SparkSession, spec: EventSpec, batch_id: int):
    """Newest event time of all batches before this one, those of earlier checkpoints included."""
    own = spark.sparkContext.getLocalProperty(QUERY_ID) or "none"
    marks = read_or_empty(spark, spec.folder("marks"), T.StructType.fromDDL(_MARK_SCHEMA))
    earlier = marks.where((F.col("query_id") != own) | (F.col("batch_id") < batch_id))
    return earlier.agg(F.max("newest").cast("string")).first()[0]


def intake(spec: EventSpec) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function: events in time are landed, all others go to the dead letters, with one audit row.

    A batch that is repeated meets the same mark and replaces what it wrote.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        begin = datetime.now(timezone.utc)
        spark = batch.sparkSession
        mark = _mark(spark, spec, batch_id)
        at = F.col(spec.event_ts)
        old = F.lit(False) if mark is None else at <= F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {spec.tolerance}")
        rows = batch.withColumn("rejection_reason", F.when(at.isNull(), UNTIMED).when(old, LATE)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            counts = rows.agg(F.count(F.lit(1)).alias("read"), F.count("rejection_reason").alias("rejected"),
                              F.max(at).alias("newest")).first()
            if not counts["read"]:
                return
            write_batch(rows.where("rejection_reason IS NULL").drop("rejection_reason"), spec.folder("intake"), batch_id)
            if counts["rejected"]:
                write_batch(rows.where("rejection_reason IS NOT NULL"), spec.folder("late"), batch_id)
            newest = rows.agg(F.max(at).cast("timestamp").alias("newest"))
            write_batch(newest, spec.folder("marks"), batch_id)
            write_batch(audit_record(
                spark, pipeline=f"intake_{spec.name}", job=spec.name, run_id=spec.run_id, source=spec.name, entity=spec.name,
                batch_id=batch_id, read=counts["read"], written=counts["read"] - counts["rejected"],
                rejected=counts["rejected"], status="SUCCESS", start=begin, end=datetime.now(timezone.utc)),
                spec.folder("intake_audit"), batch_id)
        finally:
            rows.unpersist()

    return process


def landed(spark: SparkSession, spec: EventSpec, schema: T.StructType) -> DataFrame:
    """Stream of what the intake has landed, behind the watermark, each log position once."""
    fields = T.StructType([*schema.fields, T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())])
    rows = spark.readStream.schema(fields).parquet(spec.folder("intake")).drop("query_id", "batch_id")
    return windows.drop_replays(rows.withWatermark(spec.event_ts, spec.tolerance), POSITION)


def start_windows(events: DataFrame, spec: EventSpec, checkpoint: str, width: str, mode: str, interval: str) -> StreamingQuery:
    """Append every window of valid readings once it is complete. The file sink commits a batch once."""
    summary = windows.window_summary(events.where("dq_passed"), width)
    writer = summary.writeStream.format("parquet").outputMode("append").option("path", spec.folder("windows")).option(
        "checkpointLocation", checkpoint).queryName(f"{spec.name}_windows")
    return with_trigger(writer, mode, interval).start()


def start_pipeline(raw: DataFrame, spec: EventSpec, process: Callable[[DataFrame, int], None], checkpoint: str,
                   width: str = "15 minutes", mode: str = "continuous", interval: str = "30 seconds") -> list[StreamingQuery]:
    """Start intake, event and window query over parsed and graded events. `batch` takes what is there, one after another."""
    spark = raw.sparkSession
    queries = [start(raw, intake(spec), f"{checkpoint}/intake", f"{spec.name}_intake", mode, interval)]

    def wait() -> None:
        if mode == "batch":
            queries[-1].awaitTermination()

    wait()
    events = landed(spark, spec, raw.schema)
    queries.append(start(events, process, f"{checkpoint}/events", f"{spec.name}_events", mode, interval))
    wait()
    queries.append(start_windows(events, spec, f"{checkpoint}/windows", width, mode, interval))
    wait()
    return queries


def dropped_behind_watermark(query: StreamingQuery) -> int:
    """Rows that stateful operators of a query have dropped as late: 0 behind an intake."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
