"""Column mappings from source feeds to bronze tables: (source, target, type[, rule])."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import dates, text
from carelake.functions.privacy import hash_value

Rule = Callable[[Column], Column]
Mapping = tuple[str, str, str] | tuple[str, str, str, Rule]


def map_columns(df: DataFrame, mapping: Sequence[Mapping], absent_as_null: bool = False) -> DataFrame:
    """Select, clean, cast and rename in one projection. Values that do not fit a type become NULL."""
    flat = set(df.columns)
    out = []
    for source, target, kind, *rule in mapping:
        present = "." in source or source in flat
        if not present and not absent_as_null:
            raise ValueError(f"column {source} is missing")
        col = (F.col(source) if "." in source else F.col(f"`{source}`")) if present else F.lit(None).cast("string")
        if rule:
            col = rule[0](col)
        out.append(col.try_cast(kind).alias(target))
    return df.select(*out)


def _utc(col: Column) -> Column:
    return dates.parse_instant(col)


def lab_instant(col: Column) -> Column:
    """`yyyy-MM-dd HH:mm`, else day first, else month first."""
    formats = ["yyyy-MM-dd HH:mm", "yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy HH:mm", "MM-dd-yyyy HH:mm"]
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats])


PATIENTS: list[Mapping] = [
    ("patient_id", "patient_id_src", "string", lambda c: text.prefixed_key("HIS-CHN-", c)),
    ("first_name", "first_name", "string", text.standardise),
    ("last_name", "last_name", "string", text.standardise),
    ("date_of_birth", "date_of_birth", "date", dates.parse_day_first),
    ("gender", "gender", "string", lambda c: text.map_code(c, text.GENDERS)),
    ("phone_number", "phone_number_raw", "string"),
    ("aadhaar_number", "aadhaar_hash", "string", hash_value),
    ("address_line1", "address_line1", "string", F.trim),
    ("city", "city", "string", text.standardise),
    ("pincode", "pincode", "string"),
    ("insurance_plan_id", "insurance_plan_id", "string"),
    ("blood_group", "blood_group", "string"),
    ("admission_count", "admission_count", "int"),
    ("created_at", "created_at", "timestamp", _utc),
    ("updated_at", "updated_at", "timestamp", _utc),
]

CLAIMS: list[Mapping] = [
    ("claimId", "claim_id", "string"),
    ("patientMRN", "patient_mrn_src", "string"),
    ("hospitalCode", "hospital_code", "string", text.strip_hospital_prefix),
    ("procedureCode", "procedure_code", "string", F.trim),
    ("diagnosisCode", "diagnosis_code", "string", F.trim),
    ("claimDate", "claim_date", "date"),
    ("claimAmount", "claim_amount_inr", "decimal(12,2)"),
    ("status", "status", "string"),
    ("payerCode", "payer_code", "string"),
    ("attendingPhysicianId", "physician_id", "string"),
    ("submissionTimestamp", "submission_ts", "timestamp", _utc),
    ("lastUpdated", "last_updated_ts", "timestamp", _utc),
]

LABS: list[Mapping] = [
    ("OrderID", "order_id", "string", F.trim),
    ("PatientMRN", "patient_mrn_src", "string", F.trim),
    ("TestCode", "test_code", "string", text.standardise),
    ("TestName", "test_name", "string", F.trim),
    ("SpecimenCollected", "specimen_collected_ts", "timestamp", lab_instant),
    ("SpecimenReceived", "specimen_received_ts", "timestamp", lab_instant),
    ("ResultValidated", "result_validated_ts", "timestamp", lab_instant),
    ("ResultReleased", "result_released_ts", "timestamp", lab_instant),
    ("ResultValue", "result_value", "string"),
    ("ResultUnit", "result_unit", "string", F.trim),
    ("ReferenceRangeLow", "ref_range_low", "decimal(12,4)"),
    ("ReferenceRangeHigh", "ref_range_high", "decimal(12,4)"),
    ("IsCritical", "is_critical_flag", "int"),
    ("OrderType", "order_type", "string", text.standardise),
    ("OrderingDeptCode", "dept_code", "string", F.trim),
]

APPOINTMENTS: list[Mapping] = [
    ("id", "appointment_id", "string"),
    ("patientSnapshot.mrn", "patient_mrn_src", "string"),
    ("patientSnapshot.name", "patient_name_raw", "string"),
    ("hospitalCode", "hospital_code", "string", text.strip_hospital_prefix),
    ("departmentCode", "dept_code", "string"),
    ("physicianId", "physician_id", "string"),
    ("appointmentDate", "appointment_date", "date"),
    ("appointmentTime", "appointment_time", "string"),
    ("status", "status", "string"),
    ("appointmentType", "appointment_type", "string"),
    ("chiefComplaint", "chief_complaint", "string"),
    ("createdTimestamp", "created_ts", "timestamp", _utc),
    ("modifiedTimestamp", "modified_ts", "timestamp", _utc),
]

TELEMETRY: list[Mapping] = [
    ("deviceId", "device_id", "string"),
    ("body.bedId", "bed_id", "string"),
    ("body.hospitalCode", "hospital_code", "string", text.strip_hospital_prefix),
    ("body.wardCode", "ward_code", "string"),
    ("body.patientMRN", "patient_mrn_src", "string"),
    ("body.heartRate", "heart_rate_bpm", "int"),
    ("body.spO2", "spo2_pct", "decimal(5,2)"),
    ("body.systolicBP", "systolic_bp_mmhg", "int"),
    ("body.diastolicBP", "diastolic_bp_mmhg", "int"),
    ("body.temperature", "temperature_celsius", "decimal(4,1)"),
    ("body.respiratoryRate", "respiratory_rate_bpm", "int"),
    ("body.alertFlags", "alert_flags", "string"),
    ("enqueuedTimeUtc", "enqueued_ts", "timestamp", _utc),
]

PHARMACY_CHANGES: list[Mapping] = [
    ("__op", "op_type", "string"),
    ("__commit_ts", "commit_timestamp", "timestamp", _utc),
    ("__before", "before_image", "string"),
    ("drug_id", "drug_id", "string"),
    ("drug_name", "drug_name", "string"),
    ("generic_name", "generic_name", "string"),
    ("drug_category", "drug_category", "string"),
    ("current_stock_qty", "current_stock_qty", "int"),
    ("unit_of_measure", "unit_of_measure", "string"),
    ("current_price", "current_price", "decimal(10,2)"),
    ("expiry_date", "expiry_date", "date"),
    ("hospital_code", "hospital_code", "string"),
    ("ward_code", "ward_code", "string"),
    ("reorder_level", "reorder_level", "int"),
    ("is_deleted", "is_deleted", "boolean"),
    ("updated_at", "updated_at", "timestamp", _utc),
]

ROSTER: list[Mapping] = [
    ("employee_id", "employee_id", "string", F.trim),
    ("full_name", "employee_name", "string", F.trim),
    ("department", "department", "string", text.standardise),
    ("designation", "designation", "string", F.trim),
    ("hospital", "hospital_code", "string", lambda c: text.map_code(F.trim(c), text.HOSPITAL_NAMES, F.trim(c))),
    ("shift_type", "shift_type", "string"),
    ("week_start_date", "week_start_date", "date", dates.parse_day_first),
    ("week_end_date", "week_end_date", "date", dates.parse_day_first),
    ("contact_number", "contact_number", "string"),
]
