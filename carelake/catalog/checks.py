"""Data-quality checks and the gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.catalog.bindings import Tables, midnight
from carelake.catalog.registry import query
from carelake.catalog.relational import plan_versions
from carelake.functions import clinical
from carelake.operators import incremental, kpi, quality

_LIMITS = {"patient_mrn": 2.0, "heart_rate": 1.0, "spo2": 5.0}


def _rate_sql(name: str, condition: str, limit: float) -> str:
    return (f"SELECT '{name}' AS column_name, count(*) AS total_records, count(*) FILTER ({condition}) AS null_count, "
            f"round(count(*) FILTER ({condition}) / count(*) * 100, 2) AS null_rate_pct, "
            f"count(*) FILTER ({condition}) / count(*) * 100 <= {limit} AS passed FROM vitals")


@query("dq_null_rates", " UNION ALL ".join(
    [_rate_sql(c, f"{c} IS NULL", limit) for c, limit in _LIMITS.items()]
    + [_rate_sql("identity", "patient_mrn IS NULL OR heart_rate IS NULL", 5.0)]))
def dq_null_rates(t: Tables):
    return quality.null_rates(t.vitals, _LIMITS, {"identity": ["patient_mrn", "heart_rate"]})


@query("dq_impossible", """
    WITH signals AS (
        SELECT ts, CASE WHEN event_id % 11 <> 0 THEN event_id * 7 % 450 END AS heart_rate, event_id * 3 % 101 AS spo2, event_id * 13 % 45 AS temperature_c
        FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 100 HOUR AND ts <= TIMESTAMP '2024-01-31')
    SELECT count(*) AS readings, count(*) FILTER (coalesce(heart_rate < 10 OR heart_rate > 400 OR spo2 < 20 OR temperature_c < 25, false)) AS impossible,
           count(*) FILTER (heart_rate > 400 AND spo2 >= 20 AND temperature_c >= 25) AS by_heart_rate_alone
    FROM signals""")
def dq_impossible(t: Tables):
    """Signals of a device that is out of order: values from all over the range, some missing."""
    event = F.col("event_id")
    signals = t.raw("events").select(
        F.col("ts").alias("event_ts"), F.when(event % 11 != 0, event * 7 % 450).alias("heart_rate"),
        (event * 3 % 101).cast("double").alias("spo2"), (event * 13 % 45).cast("double").alias("temperature_c"))
    recent = incremental.trailing(signals, "event_ts", midnight("2024-01-31"), "100 hours")
    rates = clinical.vitals_impossible(F.col("heart_rate"), F.lit(97.0), F.lit(37.0))
    rest = clinical.vitals_impossible(F.lit(80), F.col("spo2"), F.col("temperature_c"))
    return recent.agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(clinical.vitals_impossible(F.col("heart_rate"), F.col("spo2"), F.col("temperature_c"))).alias("impossible"),
        F.count_if(rates & ~rest & (F.col("heart_rate") > 200)).alias("by_heart_rate_alone"))


RULES = [
    {"table": "patients", "column": "balance", "rule_name": "solvent", "condition": "balance >= 0", "severity": "WARNING"},
    {"table": "patients", "column": "patient_id", "rule_name": "not_null", "condition": "patient_id IS NOT NULL", "severity": "CRITICAL"},
    {"table": "vitals", "column": "heart_rate", "rule_name": "plausible", "condition": "heart_rate < 200", "severity": "CRITICAL"},
    {"table": "vitals", "column": "patient_mrn", "rule_name": "not_null", "condition": "patient_mrn IS NOT NULL", "severity": "WARNING"},
]


def _rule_sql(strict: bool) -> str:
    def count(rule):
        test = f"NOT coalesce({rule['condition']}, false)" if strict else f"NOT ({rule['condition']})"
        return f"count(*) FILTER ({test})"

    return " UNION ALL ".join(
        f"SELECT '{r['table']}' AS table_name, '{r['column']}' AS column_name, '{r['rule_name']}' AS rule_name, "
        f"'{r['severity']}' AS severity, {count(r)} AS failed_count, {count(r)} = 0 AS passed FROM {r['table']}" for r in RULES)


@query("dq_rules", _rule_sql(False))
def dq_rules(t: Tables):
    return quality.apply_rules({"patients": t.patients, "vitals": t.vitals}, RULES)


@query("dq_rules_strict", _rule_sql(True))
def dq_rules_strict(t: Tables):
    return quality.apply_rules({"patients": t.patients, "vitals": t.vitals}, RULES, strict=True)


@query("dq_gate", f"""
    WITH failed AS (SELECT *, rule_name || ' failed for ' || failed_count || ' records in ' || table_name AS message,
                           CASE severity WHEN 'CRITICAL' THEN 3 WHEN 'WARNING' THEN 2 ELSE 1 END AS r
                    FROM ({_rule_sql(True)}) WHERE NOT passed)
    SELECT CASE WHEN coalesce(max(r), 0) >= 3 THEN 'HALT' ELSE 'PASS' END AS verdict,
           CASE max(r) WHEN 3 THEN 'CRITICAL' WHEN 2 THEN 'WARNING' WHEN 1 THEN 'INFO' ELSE 'NONE' END AS worst_severity,
           count(*) AS issues,
           (SELECT coalesce(string_agg(message, '; ' ORDER BY r DESC, message), '') FROM (SELECT * FROM failed ORDER BY r DESC, message LIMIT 5)) AS first_issues
    FROM failed""")
def dq_gate(t: Tables):
    found = quality.apply_rules({"patients": t.patients, "vitals": t.vitals}, RULES, strict=True).filter(~F.col("passed"))
    message = F.concat("rule_name", F.lit(" failed for "), "failed_count", F.lit(" records in "), "table_name")
    return quality.gate(found.select("severity", message.alias("message")))


@query("dq_duplicates", """
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys, count(*) FILTER (n > 1) AS duplicated_keys,
           CAST(sum(n - 1) AS BIGINT) AS surplus_rows, round(sum(n - 1) / sum(n) * 100, 4) AS duplicate_rate_pct, sum(n - 1) / sum(n) * 100 <= 0.1 AS passed
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)""")
def dq_duplicates(t: Tables):
    return quality.key_duplicates(t.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_one_current", """
    WITH doubled AS (SELECT * FROM versions UNION ALL SELECT * FROM versions WHERE eff_end_date IS NULL AND patient_id % 5 = 0)
    SELECT patient_id, count(*) FILTER (eff_end_date IS NULL) AS current_rows FROM doubled GROUP BY patient_id HAVING count(*) FILTER (eff_end_date IS NULL) <> 1""")
def dq_one_current(t: Tables):
    """Every fifth patient has its open version twice."""
    rows = plan_versions(t)
    return quality.multiple_current(rows.unionByName(rows.filter("is_current = 1 AND patient_id % 5 = 0")), "patient_id")


@query("dq_freshness", """
    SELECT user_id, max(ts) AS newest, max(ts) >= TIMESTAMP '2024-01-31' - INTERVAL 24 HOUR AS is_fresh FROM events GROUP BY user_id""")
def dq_freshness(t: Tables):
    return quality.freshness(t.raw("events"), "ts", midnight("2024-01-31"), 24, by=["user_id"])


@query("dq_row_drop", """
    WITH daily AS (SELECT hospital_code, admission_date, count(*) AS row_count FROM admissions GROUP BY ALL),
    prior AS (SELECT *, lag(row_count) OVER (PARTITION BY hospital_code ORDER BY admission_date) AS previous_count FROM daily)
    SELECT hospital_code, admission_date, row_count, previous_count, round((previous_count - row_count) / previous_count * 100, 2) AS drop_pct
    FROM prior WHERE (previous_count - row_count) / previous_count * 100 > 20""")
def dq_row_drop(t: Tables):
    return quality.row_count_drops(t.admissions, ["hospital_code"], "admission_date")


@query("dq_reconcile", """
    WITH bronze AS (SELECT l_suppkey AS physician_id, count(*) AS bronze_rows FROM lineitem GROUP BY ALL),
    silver AS (SELECT physician_id, count(DISTINCT (admission_id, procedure_code)) AS silver_rows FROM claims GROUP BY ALL)
    SELECT physician_id, silver_rows, bronze_rows, silver_rows - bronze_rows AS difference, round(silver_rows / bronze_rows, 4) AS count_ratio,
           silver_rows = bronze_rows AS reconciled, silver_rows / bronze_rows > 1.5 AS ratio_breach
    FROM bronze JOIN silver USING (physician_id)""")
def dq_reconcile(t: Tables):
    bronze = t.claims().groupBy("physician_id").agg(F.count(F.lit(1)).alias("bronze_rows"))
    silver = t.claims().select("physician_id", "admission_id", "procedure_code").distinct().groupBy("physician_id").agg(
        F.count(F.lit(1)).alias("silver_rows"))
    counts = silver.join(bronze, "physician_id")
    return quality.count_ratio(counts, "silver_rows", "bronze_rows")


@query("dq_required_fields", """
    SELECT event_type, count(*) AS payloads, count(*) FILTER (json_extract_string(props, '$.k') IS NULL) AS missing_k,
           count(*) FILTER (json_extract_string(props, '$.version') IS NULL) AS missing_version
    FROM events GROUP BY event_type""")
def dq_required_fields(t: Tables):
    return quality.required_payload_fields(t.raw("events"), "props", ["k", "version"], by=["event_type"])


@query("payload_drift", """
    WITH sent AS (
        SELECT event_type, CASE event_type
            WHEN 'view' THEN regexp_replace(props, '"k": ([0-9]+)', '"k": "\\1"')
            WHEN 'error' THEN replace(props, '"k"', '"code"')
            WHEN 'signup' THEN replace(props, '}', ', "extra": true}')
            WHEN 'purchase' THEN CASE WHEN event_id % 50 = 0 THEN 'cut {' ELSE props END
            ELSE props END AS payload
        FROM events),
    good AS (SELECT event_type, payload FROM sent WHERE json_valid(payload)),
    fields AS (SELECT event_type, payload, unnest(json_keys(payload)) AS f FROM good),
    kinds AS (
        SELECT event_type, f, CASE json_type(json_extract(payload, '$."' || f || '"')) WHEN 'UBIGINT' THEN 'bigint' WHEN 'BIGINT' THEN 'bigint'
               WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' END AS kind FROM fields),
    now AS (SELECT event_type, f, CASE WHEN min(kind) = max(kind) THEN min(kind) ELSE 'variant' END AS kind FROM kinds WHERE kind IS NOT NULL GROUP BY ALL),
    found AS (
        SELECT event_type, f, 'added as ' || kind AS message FROM now WHERE f <> 'k'
        UNION ALL SELECT event_type, 'k', 'removed' FROM good WHERE event_type NOT IN (SELECT event_type FROM now WHERE f = 'k') GROUP BY ALL
        UNION ALL SELECT event_type, f, 'type bigint became ' || kind FROM now WHERE f = 'k' AND kind <> 'bigint'
        UNION ALL SELECT event_type, NULL, count(*) || ' payloads are no JSON' FROM sent WHERE NOT json_valid(payload) GROUP BY ALL)
    SELECT event_type AS member, f AS column_name, 'payload_drift' AS rule_name, 'WARNING' AS severity, message FROM found""")
def payload_drift(t: Tables):
    kind, props = F.col("event_type"), F.col("props")
    payload = (
        F.when(kind == "view", F.regexp_replace(props, r'"k": ([0-9]+)', '"k": "$1"'))
        .when(kind == "error", F.replace(props, F.lit('"k"'), F.lit('"code"')))
        .when(kind == "signup", F.replace(props, F.lit("}"), F.lit(', "extra": true}')))
        .when((kind == "purchase") & (F.col("event_id") % 50 == 0), "cut {").otherwise(props))
    registered = T.StructType([T.StructField("k", T.LongType())])
    return quality.payload_drift(t.raw("events").withColumn("payload", payload), "payload", registered, "event_type")
