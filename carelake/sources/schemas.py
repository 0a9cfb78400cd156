"""Explicit schemas of every input. Field names and types of the feeds."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Text files are read as strings; types come from the column mappings.
PATIENT_CSV = _struct(
    patient_id=S, first_name=S, last_name=S, date_of_birth=S, gender=S, phone_number=S, aadhaar_number=S,
    address_line1=S, city=S, pincode=S, insurance_plan_id=S, blood_group=S, admission_count=S, created_at=S,
    updated_at=S)

LAB_REQUIRED = ["OrderID", "PatientMRN", "TestCode", "SpecimenCollected", "ResultReleased"]

ROSTER_CSV = T.StructType([T.StructField(n, S) for n in (
    "Employee ID", "Full Name", "Department", "Designation", "Hospital", "Shift Type", "Week Start Date",
    "Week End Date", "Contact Number")])

CLAIMS_PAGE = _struct(
    meta=_struct(totalRecords=L, page=I, pageSize=I, nextPageUrl=S, generatedAt=S, apiVersion=S),
    data=T.ArrayType(_struct(
        claimId=S, patientMRN=S, hospitalCode=S, procedureCode=S, diagnosisCode=S, claimDate=S, claimAmount=D,
        status=S, payerCode=S, attendingPhysicianId=S, submissionTimestamp=S, lastUpdated=S)))

APPOINTMENT = _struct(
    id=S, patientSnapshot=_struct(mrn=S, name=S), hospitalCode=S, departmentCode=S, physicianId=S,
    appointmentDate=S, appointmentTime=S, status=S, appointmentType=S, chiefComplaint=S, createdTimestamp=S,
    modifiedTimestamp=S)

TELEMETRY = _struct(
    deviceId=S,
    body=_struct(bedId=S, hospitalCode=S, wardCode=S, patientMRN=S, heartRate=I, spO2=D, systolicBP=I,
                 diastolicBP=I, temperature=D, respiratoryRate=I, alertFlags=S),
    enqueuedTimeUtc=S)

CDC_FILE = _struct(
    __op=S, __commit_ts=S, __before=S, drug_id=S, drug_name=S, generic_name=S, drug_category=S,
    current_stock_qty=I, unit_of_measure=S, current_price=D, expiry_date=S, hospital_code=S, ward_code=S,
    reorder_level=I, is_deleted=B, updated_at=S)

VITALS_EVENT = _struct(
    event_type=S, schema_version=S, device_id=S, patient_mrn=S, hospital_code=S, bed_number=I, heart_rate=I, spo2=D,
    systolic_bp=I, diastolic_bp=I, temperature_c=D, respiratory_rate=I, is_anomaly_injected=B, recorded_at=S,
    ingestion_source=S)

CLAIM_EVENT = _struct(
    event_type=S, schema_version=S, claim_id=S, patient_mrn=S, hospital_code=S, insurer_code=S, claim_amount=D,
    approved_amount=D, status=S, service_date=S, submitted_at=S, processed_at=S, icd_codes=T.ArrayType(S),
    procedure_codes=T.ArrayType(S), is_inpatient=B, ingestion_source=S)

INVENTORY_ROW = _struct(
    inventory_id=S, ndc_code=S, drug_name=S, drug_category=S, hospital_code=S, quantity_units=I, reorder_level=I,
    expiry_date=S, unit_cost_inr=D, is_critical=B, updated_at=S)

# Field names some producers use for the same columns.
INVENTORY_ALIASES = {"inventory_id": "item_id", "quantity_units": "stock_count", "updated_at": "last_updated_at"}

DISPENSING_ROW = _struct(
    dispense_id=S, prescription_id=S, patient_mrn=S, ndc_code=S, drug_name=S, quantity_dispensed=I, pharmacist_id=S,
    hospital_code=S, dispensed_at=S, lot_number=S)

_CHANGE = dict(op=S, source=_struct(table=S, ts_ms=L, txId=S), before=S, after=S, ts_ms=L)
# The envelope may be wrapped in `payload` or come bare.
CDC_ENVELOPE = _struct(payload=_struct(**_CHANGE), **_CHANGE)

KAFKA_ROW = _struct(
    key=T.BinaryType(), value=T.BinaryType(), topic=S, partition=I, offset=L, timestamp=T.TimestampType())
