"""Audit records, SLA checks, failure streaks and lineage."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators.joins import join_dimension
from carelake.operators.ordered import running_total

AUDIT_SCHEMA = T.StructType([
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("notebook_name", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("entity_name", T.StringType()),
    T.StructField("records_read", T.LongType()),
    T.StructField("records_written", T.LongType()),
    T.StructField("records_rejected", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("duration_seconds", T.LongType()),
    T.StructField("error_message", T.StringType()),
])

# Run-time limits in seconds, in general and per scheduled job.
RUNTIME_LIMIT_SECONDS = 3600
JOB_BUDGETS = [
    ("bronze_batch_ingestion", 10800),
    ("silver_transform", 7200),
    ("gold_aggregation", 3600),
    ("kafka_stream_monitor", 120),
    ("data_quality_gate", 1800),
]


def audit_record(spark: SparkSession, *, pipeline: str, job: str, run_id: str, source: str, entity: str, read: int,
                 written: int, rejected: int, status: str, start: datetime, end: datetime,
                 error: str | None = None, batch_id: int | None = None) -> DataFrame:
    """One audit row of a run, or of one of its micro-batches; the table it goes to is only ever appended to."""
    seconds = int((end - start).total_seconds())
    run = run_id if batch_id is None else f"{run_id}-batch{batch_id}"
    row = (pipeline, job, run, source, entity, read, written, rejected, status, start, end, seconds, error or "")
    return spark.createDataFrame([row], AUDIT_SCHEMA)


def audited_write(df: DataFrame, path: str, valid: str, *, pipeline: str, job: str, run_id: str, source: str, entity: str,
                  start: datetime, clock: Callable[[], datetime], partition: str = "_valid") -> DataFrame:
    """Write valid and rejected rows in one job, each in its partition of `path`, and return the audit row of the run.

    The counts are observed on the rows while they are written, so nothing is computed once more for them. NULL flags count
    as rejected. A write that fails raises, and there is no row.
    """
    seen = Observation()
    flagged = df.withColumn(partition, F.coalesce(F.col(valid), F.lit(False))).observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col(valid)).alias("written"))
    flagged.drop(valid).write.mode("overwrite").partitionBy(partition).parquet(path)
    counts = seen.get
    return audit_record(
        df.sparkSession, pipeline=pipeline, job=job, run_id=run_id, source=source, entity=entity, read=counts["read"],
        written=counts["written"], rejected=counts["read"] - counts["written"], status="SUCCESS", start=start, end=clock())


def route_counts(routed: DataFrame, valid: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows read, written and rejected from one aggregate over the routed rows."""
    measures = [
        F.count(F.lit(1)).alias("records_read"),
        F.count_if(F.col(valid)).alias("records_written"),
        F.count_if(~F.col(valid)).alias("records_rejected"),
    ]
    return routed.groupBy(*by).agg(*measures) if by else routed.agg(*measures)


def over_budget(log: DataFrame, budgets: DataFrame, name: str = "pipeline_name",
                limit: int = RUNTIME_LIMIT_SECONDS) -> DataFrame:
    """Runs longer than their pipeline's budget, or than the general limit where it has none."""
    joined = join_dimension(log, budgets, name)
    sla = F.coalesce(F.col("sla_seconds"), F.lit(limit))
    return joined.withColumn("sla_seconds", sla).filter(F.col("duration_seconds") > F.col("sla_seconds"))


def failure_streaks(log: DataFrame, key: str, order: Sequence[str], at_least: int = 1) -> DataFrame:
    """Unbroken runs of FAILED entries per key: first and last entry and length.

    The number of successes so far names the streak; it is summed slice by slice because a key (a pipeline,
    an entity) usually owns a large share of the log.
    """
    success = F.when(F.col("status") == "FAILED", 0).otherwise(1)
    marked = running_total(log, [key], order, success, "_island")
    return (
        marked.filter(F.col("status") == "FAILED")
        .groupBy(key, "_island")
        .agg(F.min(order[0]).alias("first_failure"), F.max(order[0]).alias("last_failure"),
             F.count(F.lit(1)).alias("failures"))
        .filter(F.col("failures") >= at_least)
        .drop("_island")
    )


def trace(layers: dict[str, DataFrame], run_id: str = "_run_id") -> DataFrame:
    """Rows per run in every layer, reduced to one row per run before the layers meet."""
    out = None
    for layer, df in layers.items():
        counts = df.groupBy(run_id).agg(F.count(F.lit(1)).alias(f"{layer}_rows"))
        out = counts if out is None else out.join(counts, run_id, "full_outer")
    return out.fillna(0, subset=[f"{layer}_rows" for layer in layers])
