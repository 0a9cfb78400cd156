"""Personal data: hashing, masking, scans, consent, erasure, retention and row security."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.catalog.bindings import ORDERS_AS_OF, Tables
from carelake.catalog.registry import query
from carelake.functions import checkdigits, privacy
from carelake.functions.checkdigits import LUHN_SQL, VERHOEFF_SQL
from carelake.operators import governance, joins, quality
from carelake.session import use_checkpoint_dir
from carelake.sources import erasure


@query("hash_identifier", "SELECT patient_id, city, sha256(aadhaar_number) AS aadhaar_hash FROM patients")
def hash_identifier(t: Tables):
    return privacy.hash_identifier(t.patients.select("patient_id", "city", "aadhaar_number"))


@query("mask_phone_prefix", "SELECT patient_id, 'XXXXXX' || substr(phone_number, 7) AS phone_number FROM patients")
def mask_phone_prefix(t: Tables):
    return t.patients.select("patient_id", privacy.mask_phone_prefix(F.col("phone_number")).alias("phone_number"))


@query("mask_phone_suffix", "SELECT patient_id, 'XXXXXX-' || right(phone_number, 4) AS phone_number FROM patients")
def mask_phone_suffix(t: Tables):
    return t.patients.select("patient_id", privacy.mask_phone_suffix(F.col("phone_number")).alias("phone_number"))


@query("mask_email", """
    SELECT patient_id, left(email, 1) || '***' || substr(email, strpos(email, '@') - 1) AS email FROM patients""")
def mask_email(t: Tables):
    return t.patients.select("patient_id", privacy.mask_email(F.col("email")).alias("email"))


@query("hash_columns", """
    SELECT patient_id, sha256(aadhaar_number) AS aadhaar_number_hash, sha256(email) AS email_hash FROM patients""")
def hash_columns(t: Tables):
    return privacy.hash_columns(t.patients.select("patient_id", "aadhaar_number", "email"), ["aadhaar_number", "email"])


@query("redact_address", "SELECT patient_id, '[REDACTED_TO_CITY_LEVEL]' AS address, city FROM patients")
def redact_address(t: Tables):
    addressed = t.patients.select("patient_id", F.concat("full_name", F.lit(" street")).alias("address"), "city")
    return privacy.redact_address(addressed)


@query("mask_card", """
    SELECT c_custkey AS patient_id, 'XXXX-XXXX-XXXX-' || right(CAST(c_custkey + 4000123412340000 AS VARCHAR), 4) AS card FROM customer""")
def mask_card(t: Tables):
    card = (F.col("c_custkey") + 4000123412340000).cast("string")
    return t.raw("customer").select(F.col("c_custkey").alias("patient_id"), privacy.mask_card(card).alias("card"))


@query("mask_by_policy", """
    SELECT patient_id, sha256(aadhaar_number) AS aadhaar_number_hash, 'XXXXXX' || substr(phone_number, 7) AS phone_number,
           left(email, 1) || '***' || substr(email, strpos(email, '@') - 1) AS email, full_name, sha256(city) AS city_hash
    FROM patients""")
def mask_by_policy(t: Tables):
    rows = t.patients.select("patient_id", "aadhaar_number", "phone_number", "email", "full_name", "city")
    policy = {"aadhaar_number": "CRITICAL", "phone_number": "HIGH", "email": "HIGH", "full_name": "MEDIUM", "patient_id": "LOW",
              "city": "HIGH"}
    return privacy.mask_by_policy(rows, policy, {"email": privacy.mask_email, "phone_number": privacy.mask_phone_prefix})


_SCANNED = {"documents": ["text", "source"], "pages": ["html", "url"], "conversations": ["text"], "benchmark": ["text"]}
_SCAN_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{name}' AS pattern, "
    f"count(*) FILTER (regexp_matches({column}, '{pattern}')) AS hits FROM {table}"
    for table, columns in _SCANNED.items() for column in columns for name, pattern in privacy.VALUE_PATTERNS.items())


@query("pii_value_scan", _SCAN_SQL)
def pii_value_scan(t: Tables):
    parts = [quality.value_scan(t.raw(table), table, columns) for table, columns in _SCANNED.items()]
    return reduce(DataFrame.unionByName, parts)


_CHECK_SQL = {"identifier_12": VERHOEFF_SQL, "card": LUHN_SQL}
_CHECKED_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{name}' AS pattern, "
    f"count(*) FILTER (regexp_matches({column}, '{pattern}')) AS hits, "
    f"count(*) FILTER (len(list_filter(regexp_extract_all({column}, '{pattern}'), lambda m: {_CHECK_SQL[name].format(n='m')})) > 0) AS valid_hits FROM {table}"
    for table, columns in _SCANNED.items() for column in columns for name, (pattern, _) in quality.CHECKED_PATTERNS.items())


@query("pii_checked_scan", _CHECKED_SQL)
def pii_checked_scan(t: Tables):
    parts = [quality.checked_scan(t.raw(table), table, columns) for table, columns in _SCANNED.items()]
    return reduce(DataFrame.unionByName, parts)


@query("check_digits", f"""
    WITH numbers AS (SELECT c_custkey AS patient_id, CAST(c_custkey + 512345678900 AS VARCHAR) AS identifier, '4539' || lpad(CAST(c_custkey * 7919 AS VARCHAR), 12, '0') AS card FROM customer)
    SELECT patient_id, identifier, card, {VERHOEFF_SQL.format(n='identifier')} AS identifier_valid, {LUHN_SQL.format(n='card')} AS card_valid FROM numbers""")
def check_digits(t: Tables):
    key = F.col("c_custkey")
    numbers = t.raw("customer").select(
        key.alias("patient_id"), (key + 512345678900).cast("string").alias("identifier"),
        F.concat(F.lit("4539"), F.lpad((key * 7919).cast("string"), 12, "0")).alias("card"))
    return numbers.withColumns({
        "identifier_valid": checkdigits.verhoeff_valid(F.col("identifier")), "card_valid": checkdigits.luhn_valid(F.col("card"))})


@query("consent_filter", """
    SELECT admission_id, patient_id, admission_date FROM admissions
    WHERE patient_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def consent_filter(t: Tables):
    consents = t.raw("customer").select(F.col("c_custkey").alias("patient_id"), (F.col("c_acctbal") >= 0).alias("consent"))
    return governance.with_consent(t.admissions, consents, "patient_id").select(
        "admission_id", "patient_id", "admission_date")


@query("erase_subjects", """
    SELECT 'patients' AS table_name, count(*) AS kept_rows FROM customer WHERE c_acctbal >= -900
    UNION ALL
    SELECT 'admissions', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < -900)
    UNION ALL
    SELECT 'claims', count(*) FROM claims WHERE patient_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < -900)""")
def erase_subjects(t: Tables):
    gone = t.raw("customer").filter(F.col("c_acctbal") < -900).select(F.col("c_custkey").alias("patient_id"))
    kept = governance.erase(
        {"patients": t.patients, "admissions": t.admissions, "claims": t.claims(patient=True)}, gone, "patient_id")
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("kept_rows")) for name, df in kept.items()]
    return reduce(DataFrame.unionByName, counts)


@query("erase_claims", """
    SELECT claim_id, patient_id, status FROM claims
    WHERE patient_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < -900)""")
def erase_claims(t: Tables):
    gone = t.raw("customer").filter(F.col("c_acctbal") < -900).select(F.col("c_custkey").alias("patient_id"))
    return governance.erase({"claims": t.claims(patient=True)}, gone, "patient_id")["claims"].select(
        "claim_id", "patient_id", "status")


@query("erase_stored", """
    WITH gone AS (SELECT c_custkey FROM customer WHERE c_acctbal < -900),
    stored AS (
        SELECT 'admissions' AS table_name, 'year=' || year(admission_date) AS partition, patient_id FROM admissions
        UNION ALL SELECT 'patients', '', patient_id FROM patients)
    SELECT table_name, partition, count(*) AS rows_before, count(c_custkey) AS rows_erased, count(*) - count(c_custkey) AS rows_left, true AS verified
    FROM stored LEFT JOIN gone ON c_custkey = patient_id GROUP BY ALL HAVING count(c_custkey) > 0""")
def erase_stored(t: Tables):
    """Admissions stored by year and patients in one folder, after some patients have been erased."""
    root = f"{use_checkpoint_dir(t.spark)}/erasure-{uuid.uuid4().hex}"
    t.admissions.withColumn("year", F.year("admission_date")).hint("rebalance", F.col("year")).write.partitionBy("year").parquet(f"{root}/admissions")
    t.patients.write.parquet(f"{root}/patients")
    gone = t.raw("customer").filter(F.col("c_acctbal") < -900).select("c_custkey")
    manifest = erasure.erase_stored(t.spark, {
        "admissions": (f"{root}/admissions", "patient_id"), "patients": (f"{root}/patients", "patient_id")}, gone, "run")
    return manifest.select("table_name", "partition", "rows_before", "rows_erased", "rows_left", "verified")


@query("retention_class", """
    SELECT admission_id, admission_date,
           CASE WHEN admission_date <= DATE '2001-12-31' - INTERVAL 7 YEAR THEN 'DELETE'
                WHEN admission_date <= DATE '2001-12-31' - INTERVAL 3 YEAR THEN 'ARCHIVE' ELSE 'KEEP' END AS retention
    FROM admissions""")
def retention_class(t: Tables):
    return t.admissions.select("admission_id", "admission_date").withColumn(
        "retention", governance.retention_class(F.col("admission_date"), F.lit(ORDERS_AS_OF).cast("date"), "bronze"))


@query("retention_keep", """
    SELECT claim_id, claim_date FROM claims WHERE claim_date > DATE '2001-12-31' - INTERVAL 3 YEAR""")
def retention_keep(t: Tables):
    return governance.split_by_retention(
        t.claims().select("claim_id", "claim_date"), "claim_date", F.lit(ORDERS_AS_OF).cast("date"), "bronze")["KEEP"]


_USERS = [("director.mdu", "MDU"), ("director.chn", "CHN"), ("regional.south", "CBE"), ("regional.south", "TRV")]


@query("row_security", """
    SELECT admission_id, hospital_code, dept_code FROM admissions WHERE hospital_code IN ('CBE', 'TRV')""")
def row_security(t: Tables):
    mapping = joins.literal_table(t.spark, _USERS, "user_name string, hospital_code string")
    return governance.visible_rows(t.admissions, mapping, "regional.south").select(
        "admission_id", "hospital_code", "dept_code")
