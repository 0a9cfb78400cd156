"""Cleansing and row-level rules."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.catalog.bindings import Tables
from carelake.catalog.registry import query
from carelake.functions import clinical, dates, text
from carelake.operators import calendar
from carelake.operators.joins import literal_table
from carelake.plans import layers


@query("parse_two_formats", """
    SELECT o_orderkey,
           CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%m-%d-%Y')
                WHEN o_orderpriority = '5-LOW' THEN 'xx' ELSE strftime(o_orderdate, '%d-%m-%Y') END AS raw_date,
           CAST(CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                WHEN o_orderpriority = '1-URGENT' AND day(o_orderdate) <= 12
                    THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate))
                ELSE o_orderdate END AS DATE) AS parsed_date
    FROM orders""")
def parse_two_formats(t: Tables):
    day, kind = F.col("o_orderdate"), F.col("o_orderpriority")
    raw = (F.when(kind == "1-URGENT", F.date_format(day, "MM-dd-yyyy")).when(kind == "5-LOW", "xx")
           .otherwise(F.date_format(day, "dd-MM-yyyy")))
    return t.raw("orders").select("o_orderkey", raw.alias("raw_date")).withColumn(
        "parsed_date", dates.parse_day_first(F.col("raw_date")))


@query("std_text", """
    SELECT doc_id, upper(trim(lang)) AS lang, upper(trim(source)) AS source FROM documents""")
def std_text(t: Tables):
    return t.raw("documents").select(
        "doc_id", text.standardise(F.col("lang")).alias("lang"), text.standardise(F.col("source")).alias("source"))


@query("prefix_key", "SELECT patient_id, global_patient_id FROM patients")
def prefix_key(t: Tables):
    return t.raw("customer").select(
        F.col("c_custkey").alias("patient_id"),
        text.prefixed_key("HIS-CHN-", F.col("c_custkey")).alias("global_patient_id"))


@query("to_utc", """
    SELECT event_id, ts AS local_ts, ts - INTERVAL 330 MINUTE AS utc_ts FROM events""")
def to_utc(t: Tables):
    utc = dates.to_utc(F.col("ts").cast("timestamp"), "Asia/Kolkata").cast("timestamp_ntz")
    return t.raw("events").select("event_id", F.col("ts").alias("local_ts"), utc.alias("utc_ts"))


@query("null_defaults", """
    SELECT event_id, coalesce(patient_mrn, 'UNKNOWN') AS patient_mrn, coalesce(heart_rate, -1) AS heart_rate, spo2 FROM vitals""")
def null_defaults(t: Tables):
    return text.null_defaults(t.vitals.select("event_id", "patient_mrn", "heart_rate", "spo2"))


@query("code_map", """
    SELECT c_custkey AS patient_id,
           CASE left(c_mktsegment, 1) WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Other' END AS gender,
           CASE c_nationkey % 5 WHEN 0 THEN 'CHN' WHEN 1 THEN 'MDU' WHEN 2 THEN 'CBE' WHEN 3 THEN 'TRV' ELSE 'Elsewhere' END AS hospital_code
    FROM customer""")
def code_map(t: Tables):
    names = F.array(*[F.lit(x) for x in [*text.HOSPITAL_NAMES, "Elsewhere"]])
    name = F.element_at(names, F.col("c_nationkey") % 5 + 1)
    return t.raw("customer").select(
        F.col("c_custkey").alias("patient_id"),
        text.map_code(F.left("c_mktsegment", F.lit(1)), text.GENDERS).alias("gender"),
        text.map_code(name, text.HOSPITAL_NAMES, name).alias("hospital_code"))


@query("validate_format", """
    SELECT c_custkey AS patient_id, regexp_full_match(CAST(c_custkey + 599500 AS VARCHAR), '[0-9]{6}') AS pincode_ok,
           c_nationkey % 9 <> 8 AS blood_group_ok, c_mktsegment IN ('BUILDING', 'MACHINERY') AS segment_ok
    FROM customer""")
def validate_format(t: Tables):
    groups = F.array(*[F.lit(x) for x in [*text.BLOOD_GROUPS, "Z"]])
    return t.raw("customer").select(
        F.col("c_custkey").alias("patient_id"),
        text.is_pincode((F.col("c_custkey") + 599500).cast("string")).alias("pincode_ok"),
        text.is_one_of(F.element_at(groups, F.col("c_nationkey") % 9 + 1), text.BLOOD_GROUPS).alias("blood_group_ok"),
        text.is_one_of(F.col("c_mktsegment"), ["BUILDING", "MACHINERY"]).alias("segment_ok"))


@query("array_join_codes", """
    SELECT p_partkey, replace(p_name, ' ', '|') AS codes FROM part""")
def array_join_codes(t: Tables):
    return t.raw("part").select("p_partkey", text.join_codes(F.split("p_name", " ")).alias("codes"))


@query("array_size", """
    SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS code_count FROM part""")
def array_size(t: Tables):
    return t.raw("part").select("p_partkey", F.size(F.split("p_name", " ")).alias("code_count"))


@query("approval_ratio", """
    WITH c AS (SELECT claim_id, CAST(CASE WHEN procedure_code = 0 THEN 0 ELSE claim_amount END AS DOUBLE) AS amount,
                      CAST(approved_amount AS DOUBLE) AS approved FROM claims)
    SELECT claim_id, CASE WHEN amount > 0 THEN round(approved / amount, 6) END AS approval_ratio FROM c""")
def approval_ratio(t: Tables):
    amount = F.when(F.col("procedure_code") == 0, 0.0).otherwise(F.col("claim_amount").cast("double"))
    return t.claims().select(
        "claim_id", F.round(clinical.approval_ratio(F.col("approved_amount").cast("double"), amount), 6).alias("approval_ratio"))


@query("claim_flags", """
    SELECT claim_id, claim_amount > 100000 AS is_high_value, status = 'DENIED' AND claim_amount > 50000 AS fraud_risk_flag
    FROM claims""")
def claim_flags(t: Tables):
    return t.claims().select(
        "claim_id", clinical.is_high_value(F.col("claim_amount")).alias("is_high_value"),
        clinical.is_fraud_risk(F.col("status"), F.col("claim_amount")).alias("fraud_risk_flag"))


@query("vitals_severity", "SELECT event_id, hospital_code, heart_rate, spo2, alert_level FROM graded")
def vitals_severity(t: Tables):
    level = clinical.vitals_severity(*[F.col(c) for c in ("heart_rate", "spo2", "systolic_bp", "temperature_c")])
    return t.vitals.withColumn("alert_level", level).select(
        "event_id", "hospital_code", "heart_rate", "spo2", "alert_level")


@query("json_parse", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def json_parse(t: Tables):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return t.raw("events").select("event_id", F.from_json("props", schema).alias("data")).select("event_id", "data.*")


@query("event_date", """
    SELECT event_id, CAST(ts AS DATE) AS event_date, hour(ts)::INTEGER AS event_hour FROM events""")
def event_date(t: Tables):
    written = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return t.raw("events").select("event_id", dates.parse_instant(written).alias("at")).select(
        "event_id", F.to_date("at").alias("event_date"), F.hour("at").alias("event_hour"))


@query("length_of_stay", """
    SELECT admission_id, CAST(discharge_date - admission_date AS INTEGER) AS los_days FROM admissions""")
def length_of_stay(t: Tables):
    return t.admissions.select(
        "admission_id", dates.days_between(F.col("discharge_date"), F.col("admission_date")).alias("los_days"))


@query("business_days", """
    SELECT admission_id, CAST(CASE WHEN discharge_date IS NULL THEN NULL ELSE
        (SELECT count(*) FROM range(1, 10) AS r(i)
         WHERE admission_date + CAST(i AS INTEGER) <= discharge_date AND isodow(admission_date + CAST(i AS INTEGER)) < 6) END AS INTEGER) AS business_days
    FROM admissions""")
def business_days(t: Tables):
    return t.admissions.select(
        "admission_id", dates.business_days(F.col("admission_date"), F.col("discharge_date")).alias("business_days"))


# The days off of every year, by month and day.
_DAYS_OFF = [(1, 26), (5, 1), (8, 15), (10, 2), (12, 25)]


@query("business_days_holidays", f"""
    WITH off AS (SELECT make_date(CAST(y AS INTEGER), m, d) AS day FROM range(1990, 2004) AS r(y), (VALUES {', '.join(map(str, _DAYS_OFF))}) AS v(m, d)),
    stays AS (
        SELECT admission_id, CASE WHEN admission_id % 7 = 0 THEN discharge_date ELSE admission_date END AS since,
               CASE WHEN admission_id % 7 = 0 THEN admission_date ELSE discharge_date END AS until FROM admissions)
    SELECT admission_id, CAST(CASE WHEN since IS NULL OR until IS NULL THEN NULL ELSE sign(until - since) * (
        SELECT count(*) FROM range(1, 10) AS r(i)
        WHERE least(since, until) + CAST(i AS INTEGER) <= greatest(since, until) AND isodow(least(since, until) + CAST(i AS INTEGER)) < 6
              AND least(since, until) + CAST(i AS INTEGER) NOT IN (SELECT day FROM off)) END AS INTEGER) AS business_days
    FROM stays""")
def business_days_holidays(t: Tables):
    """Every seventh stay has its dates reversed."""
    off = literal_table(t.spark, [(f"{y}-{m:02d}-{d:02d}",) for y in range(1990, 2004) for m, d in _DAYS_OFF], "day string")
    turned = F.col("admission_id") % 7 == 0
    stays = t.admissions.select(
        "admission_id", F.when(turned, F.col("discharge_date")).otherwise(F.col("admission_date")).alias("since"),
        F.when(turned, F.col("admission_date")).otherwise(F.col("discharge_date")).alias("until"))
    days = calendar.business_calendar(t.spark, "1990-01-01", "2003-12-31", off)
    return calendar.with_business_days(stays, days, "since", "until", "business_days").select("admission_id", "business_days")


@query("record_hash", """
    SELECT event_id, sha256(concat_ws('|', coalesce(patient_mrn, '∅'), coalesce(CAST(heart_rate AS VARCHAR), '∅'), hospital_code)) AS record_hash
    FROM vitals""")
def record_hash(t: Tables):
    return t.vitals.select("event_id", text.record_hash("patient_mrn", "heart_rate", "hospital_code").alias("record_hash"))


@query("filter_ops", """
    SELECT inventory_id, op, "offset" FROM changes WHERE op IN ('u', 'c')""")
def filter_ops(t: Tables):
    return t.changes.filter(F.col("op").isin("u", "c")).select("inventory_id", "op", "offset")


@query("silver_standard", """
    SELECT event_id, ts - INTERVAL 330 MINUTE AS ts, coalesce(upper(trim(patient_mrn)), 'UNKNOWN') AS patient_mrn,
           coalesce(heart_rate, -1) AS heart_rate, hospital_code, spo2
    FROM vitals JOIN events USING (event_id)""")
def silver_standard(t: Tables):
    rows = t.vitals.select(
        "event_id", F.col("event_ts").cast("timestamp").alias("ts"), F.concat(F.lit(" "), F.lower("patient_mrn")).alias("patient_mrn"),
        "heart_rate", F.lower("hospital_code").alias("hospital_code"), "spo2")
    return layers.standardised(rows, "Asia/Kolkata").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
