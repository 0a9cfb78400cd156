"""Event parsing and enrichment as plain DataFrame functions: the same code serves streams and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import clinical, dates, text
from carelake.sources import schemas
from carelake.sources.kafka import LATE_TOLERANCE


def _payload(raw: DataFrame, schema) -> DataFrame:
    """Log rows with the JSON value expanded; unreadable text gives NULL fields."""
    return raw.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        "topic", "partition", "offset", F.col("timestamp").alias("kafka_timestamp"),
    ).select("kafka_key", "data.*", "topic", "partition", "offset", "kafka_timestamp")


def _stamped(df: DataFrame, source: str, run_id: str, loaded_at: Column | None) -> DataFrame:
    return df.withColumns({
        "_source_system": F.lit(source),
        "_load_timestamp": F.current_timestamp() if loaded_at is None else loaded_at,
        "_run_id": F.lit(run_id),
        "_kafka_partition": F.col("partition"),
        "_kafka_offset": F.col("offset"),
    })


def grade_vitals(df: DataFrame) -> DataFrame:
    """Severity tier and row check."""
    hr, spo2, systolic, temp = (F.col(c) for c in ("heart_rate", "spo2", "systolic_bp", "temperature_c"))
    return df.withColumns({
        "alert_level": clinical.vitals_severity(hr, spo2, systolic, temp),
        "dq_passed": clinical.vitals_quality(hr, spo2, systolic, F.col("patient_mrn"), F.col("device_id")),
    })


def vitals(raw: DataFrame, run_id: str, loaded_at: Column | None = None) -> DataFrame:
    """Vitals events: parsed, graded, with the five-minute watermark on the event time."""
    parsed = _payload(raw, schemas.VITALS_EVENT).withColumn("event_ts", dates.parse_instant(F.col("recorded_at")))
    marked = parsed.withWatermark("event_ts", LATE_TOLERANCE["vitals"])
    return grade_vitals(_stamped(marked, "KAFKA_ICU_VITALS", run_id, loaded_at))


def grade_claims(df: DataFrame) -> DataFrame:
    """Derived claim columns, flags and row check."""
    amount, status = F.col("claim_amount"), F.col("status")
    return df.withColumns({
        "icd_codes_str": text.join_codes(F.col("icd_codes")),
        "procedure_codes_str": text.join_codes(F.col("procedure_codes")),
        "icd_count": F.size("icd_codes"),
        "is_high_value": clinical.is_high_value(amount),
        "approval_ratio": clinical.approval_ratio(F.col("approved_amount"), amount),
        "fraud_risk_flag": clinical.is_fraud_risk(status, amount),
        "dq_passed": clinical.claim_quality(F.col("claim_id"), F.col("patient_mrn"), amount, status,
                                            F.col("hospital_code")),
    })


def claims(raw: DataFrame, run_id: str, loaded_at: Column | None = None) -> DataFrame:
    """Claim events: parsed, flagged, with the thirty-minute watermark on the submission time."""
    parsed = _payload(raw, schemas.CLAIM_EVENT).withColumns({
        "submitted_ts": dates.parse_instant(F.col("submitted_at")),
        "service_date_ts": dates.parse_instant(F.col("service_date")).cast("date"),
    })
    marked = parsed.withWatermark("submitted_ts", LATE_TOLERANCE["claims"])
    return grade_claims(_stamped(marked, "KAFKA_CLAIMS", run_id, loaded_at))


def changes(raw: DataFrame) -> DataFrame:
    """Change events with operation, table, images, transaction and commit order. Wrapped and bare
    envelopes are both read."""
    env = F.from_json(F.col("value").cast("string"), schemas.CDC_ENVELOPE)
    parsed = raw.select(env.alias("e"), "partition", "offset", F.col("timestamp").alias("kafka_timestamp"))

    def either(field: str) -> Column:
        return F.coalesce(F.col(f"e.payload.{field}"), F.col(f"e.{field}"))

    return parsed.select(
        either("op").alias("op"), either("source.table").alias("src_table"),
        F.coalesce(either("source.ts_ms"), either("ts_ms"), F.unix_millis("kafka_timestamp")).alias("ts_ms"),
        either("source.txId").alias("txn_id"), either("before").alias("before_json"),
        either("after").alias("after_json"), "partition", "offset", "kafka_timestamp")


def inventory_changes(events: DataFrame) -> DataFrame:
    """Inventory row images with key, operation and order; a delete takes its key from the image before."""
    schema = schemas.INVENTORY_ROW
    aliased = type(schema)([*schema.fields, *[
        type(schema.fields[0])(alias, schema[name].dataType) for name, alias in schemas.INVENTORY_ALIASES.items()]])
    image = F.when(F.col("op") == "d", F.col("before_json")).otherwise(F.col("after_json"))
    rows = events.filter(F.col("src_table") == "drug_inventory").withColumn("r", F.from_json(image, aliased))
    fields = [
        F.coalesce(F.col(f"r.{f}"), F.col(f"r.{schemas.INVENTORY_ALIASES[f]}")).alias(f)
        if f in schemas.INVENTORY_ALIASES else F.col(f"r.{f}").alias(f)
        for f in schema.fieldNames()]
    return rows.select(*fields, "op", "txn_id", "ts_ms", "offset", "kafka_timestamp").filter("inventory_id IS NOT NULL")


def dispensing_inserts(events: DataFrame) -> DataFrame:
    """Dispensing log entries: inserts only."""
    rows = events.filter((F.col("src_table") == "dispensing_log") & (F.col("op") == "c"))
    parsed = rows.withColumn("r", F.from_json("after_json", schemas.DISPENSING_ROW))
    return parsed.select("r.*", "txn_id", "offset", F.col("kafka_timestamp").alias("_kafka_ts"))
