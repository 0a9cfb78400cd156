"""Event-time windows, duplicate suppression, late events and consumer lag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.ordered import running_max


def window_summary(vitals: DataFrame, width: str, by: Sequence[str] = ("hospital_code",)) -> DataFrame:
    """Readings per tumbling window; works on streams (behind a watermark) and batches."""
    return vitals.groupBy(F.window("event_ts", width).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("readings"),
        F.avg("heart_rate").alias("avg_heart_rate"),
        F.min("spo2").alias("min_spo2"),
        F.count_if(F.col("alert_level") == "CRITICAL").alias("critical_alerts"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
             "readings", "avg_heart_rate", "min_spo2", "critical_alerts")


def drop_replays(events: DataFrame, keys: Sequence[str] = ("topic", "partition", "offset")) -> DataFrame:
    """Replayed events of a stream are dropped; state is kept for the watermark only."""
    return events.dropDuplicatesWithinWatermark(list(keys))


def classify_late(events: DataFrame, event_ts: str, arrival: Sequence[str], minutes: int,
                  keys: Sequence[str]) -> DataFrame:
    """Batch twin of the late-data policy: an event is late when it is older than the newest event that
    arrived before or with it, less the tolerance. `keys` separate the streams."""
    seen = running_max(events, keys, arrival, F.col(event_ts), "_newest")
    late = F.col(event_ts) < F.col("_newest") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return seen.withColumn("lateness", F.when(late, "LATE").otherwise("ON_TIME")).drop("_newest")


def consumer_lag(offsets: DataFrame, limits: DataFrame) -> DataFrame:
    """Lag per topic over `(topic, partition, end_offset, committed_offset)` against its limit."""
    behind = F.col("end_offset") - F.coalesce(F.col("committed_offset"), F.lit(0))
    lag = offsets.groupBy("topic").agg(F.sum(behind).alias("total_lag"))
    return lag.join(limits, "topic", "left").withColumn(
        "status", F.when(F.col("total_lag") > F.col("lag_limit"), "BREACH").otherwise("OK"))
