"""Batch twins of the streaming operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.catalog.bindings import Tables, minutes
from carelake.catalog.registry import query
from carelake.operators.joins import literal_table
from carelake.sources import sinks
from carelake.streaming import parse, windows


@query("dlq_split", """
    SELECT event_id, hospital_code, heart_rate, spo2, CASE WHEN dq_passed THEN NULL ELSE 'out of range' END AS rejection_reason FROM graded""")
def dlq_split(t: Tables):
    graded = parse.grade_vitals(t.vitals).select("event_id", "hospital_code", "heart_rate", "spo2", "dq_passed")
    valid, rejected = sinks.split_rejected(graded, "dq_passed", "out of range")
    return valid.unionByName(rejected, allowMissingColumns=True)


def _window_sql(width: str) -> str:
    return f"""
    SELECT time_bucket(INTERVAL '{width}', event_ts) AS window_start, time_bucket(INTERVAL '{width}', event_ts) + INTERVAL '{width}' AS window_end,
           hospital_code, count(*) AS readings, avg(heart_rate) AS avg_heart_rate, min(spo2) AS min_spo2,
           count(*) FILTER (alert_level = 'CRITICAL') AS critical_alerts
    FROM graded GROUP BY ALL"""


@query("vitals_5min", _window_sql("5 minutes"))
def vitals_5min(t: Tables):
    return windows.window_summary(parse.grade_vitals(t.vitals), "5 minutes")


@query("vitals_15min", _window_sql("15 minutes"))
def vitals_15min(t: Tables):
    return windows.window_summary(parse.grade_vitals(t.vitals), "15 minutes")


_LATE_TS = "CASE WHEN event_id % 20 = 0 THEN ts - INTERVAL 10 MINUTE ELSE ts END"


@query("late_events", f"""
    SELECT event_id, event_ts, CASE WHEN event_ts < max(event_ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) - INTERVAL 5 MINUTE THEN 'LATE' ELSE 'ON_TIME' END AS lateness
    FROM (SELECT event_id, event_type, ts, {_LATE_TS} AS event_ts FROM events)""")
def late_events(t: Tables):
    late = F.when(F.col("event_id") % 20 == 0, F.col("ts") - minutes(F.lit(10))).otherwise(F.col("ts"))
    events = t.raw("events").select("event_id", "event_type", "ts", late.alias("event_ts"))
    out = windows.classify_late(events, "event_ts", ["ts", "event_id"], 5, ["event_type"])
    return out.select("event_id", "event_ts", "lateness")


_CLAIM_DQ = "coalesce(claim_amount > 1000 AND status <> 'PENDING', false)"


@query("dlq_unified", f"""
    SELECT 'vitals' AS source, CAST(event_id AS VARCHAR) AS event_key, hospital_code, 'out of range' AS rejection_reason, CAST(NULL AS VARCHAR) AS status FROM graded WHERE NOT dq_passed
    UNION ALL
    SELECT 'claims', claim_id, hospital_code, 'invalid claim', status FROM claims WHERE status = 'PENDING' OR claim_amount <= 1000""")
def dlq_unified(t: Tables):
    graded = parse.grade_vitals(t.vitals).select(F.col("event_id").cast("string").alias("event_key"), "hospital_code", "dq_passed")
    claims = t.claims().select(
        F.col("claim_id").alias("event_key"), "hospital_code", "status",
        ((F.col("claim_amount") > 1000) & (F.col("status") != "PENDING")).alias("dq_passed"))
    return sinks.dead_letters({
        "vitals": sinks.split_rejected(graded, "dq_passed", "out of range")[1],
        "claims": sinks.split_rejected(claims, "dq_passed", "invalid claim")[1],
    }).select("source", "event_key", "hospital_code", "rejection_reason", "status")


@query("stream_lag", """
    WITH o AS (SELECT event_type AS topic, user_id % 12 AS p, max(event_id) AS e, max(event_id) FILTER (value < 100) AS c FROM events GROUP BY ALL)
    SELECT topic, CAST(sum(e - coalesce(c, 0)) AS BIGINT) AS total_lag, lag_limit,
           CASE WHEN sum(e - coalesce(c, 0)) > lag_limit THEN 'BREACH' ELSE 'OK' END AS status
    FROM o LEFT JOIN (VALUES ('signup', 500), ('error', 200), ('click', 100), ('view', 2000), ('purchase', 5000)) AS l(topic, lag_limit) USING (topic)
    GROUP BY topic, lag_limit""")
def stream_lag(t: Tables):
    offsets = t.raw("events").groupBy(F.col("event_type").alias("topic"), (F.col("user_id") % 12).alias("partition")).agg(
        F.max("event_id").alias("end_offset"), F.max(F.when(F.col("value") < 100, F.col("event_id"))).alias("committed_offset"))
    limits = literal_table(
        t.spark, [("signup", 500), ("error", 200), ("click", 100), ("view", 2000), ("purchase", 5000)], "topic string, lag_limit int")
    return windows.consumer_lag(offsets, limits)


@query("claims_stream_twin", """
    SELECT claim_id, status, procedure_code || '|' || hospital_code AS procedure_codes_str, CAST(2 AS INTEGER) AS icd_count,
           CAST(claim_amount AS DOUBLE) > 100000 AS is_high_value,
           CASE WHEN claim_amount > 0 THEN round(CAST(approved_amount AS DOUBLE) / CAST(claim_amount AS DOUBLE), 6) END AS approval_ratio,
           status = 'DENIED' AND claim_amount > 50000 AS fraud_risk_flag,
           claim_amount > 0 AS dq_passed
    FROM claims""")
def claims_stream_twin(t: Tables):
    events = t.claims().select(
        "claim_id", F.col("admission_id").cast("string").alias("patient_mrn"), "hospital_code", "status",
        F.col("claim_amount").cast("double").alias("claim_amount"), F.col("approved_amount").cast("double").alias("approved_amount"),
        F.array(F.lit("J06.9"), F.lit("I10")).alias("icd_codes"),
        F.array(F.col("procedure_code").cast("string"), "hospital_code").alias("procedure_codes"))
    return parse.grade_claims(events).select(
        "claim_id", "status", "procedure_codes_str", "icd_count", "is_high_value",
        F.round("approval_ratio", 6).alias("approval_ratio"), "fraud_risk_flag", "dq_passed")


@query("vitals_json_twin", """
    SELECT event_id AS "offset", CAST(device_id AS VARCHAR) AS device_id, hospital_code, heart_rate, spo2, alert_level, dq_passed FROM graded""")
def vitals_json_twin(t: Tables):
    """Vitals written as JSON log rows and read back through the stream's parser."""
    body = F.to_json(F.struct(
        F.col("device_id").cast("string").alias("device_id"), "patient_mrn", "hospital_code", "heart_rate", "spo2",
        "systolic_bp", "temperature_c", F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("recorded_at")))
    raw = t.vitals.select(
        F.col("device_id").cast("string").cast("binary").alias("key"), body.cast("binary").alias("value"),
        F.lit("icu.vitals").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.col("event_ts").cast("timestamp").alias("timestamp"))
    return parse.vitals(raw, "twin", F.lit(None).cast("timestamp")).select(
        "offset", "device_id", "hospital_code", "heart_rate", "spo2", "alert_level", "dq_passed")
