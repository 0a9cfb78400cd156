"""Scans, mappings, incremental loads and file bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from carelake.catalog.bindings import Tables, midnight
from carelake.catalog.registry import query
from carelake.operators import cdc, incremental
from carelake.operators.ordered import latest_per_key
from carelake.sources import mappings, sinks


@query("scan_parquet", """
    SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def scan_parquet(t: Tables):
    day = F.col("o_orderdate")
    return t.raw("orders").filter((day >= midnight("1998-01-01")) & (day < midnight("1999-01-01"))).select(
        "o_orderkey", "o_custkey", day.cast("date").alias("order_date"))


@query("file_audit_anti", """
    SELECT source AS source_system, 'doc-' || doc_id AS filename, n_chars AS file_size FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def file_audit_anti(t: Tables):
    return incremental.new_files(_listing(t), _file_log(t))


def _listing(t: Tables):
    return t.raw("documents").select(
        F.col("source").alias("source_system"), F.concat(F.lit("doc-"), "doc_id").alias("filename"),
        F.col("n_chars").alias("file_size"))


def _file_log(t: Tables):
    """Files loaded before: labelled documents, SUCCESS where the quality label is 1."""
    docs = t.raw("documents").select("doc_id", "source")
    return t.raw("labels").join(docs, "doc_id").select(
        F.col("source").alias("source_system"), F.concat(F.lit("doc-"), "doc_id").alias("filename"),
        F.when(F.col("quality") == 1, "SUCCESS").otherwise("FAILED").alias("load_status"))


@query("file_audit_status", """
    SELECT source AS source_system, 'doc-' || doc_id AS filename, n_chars AS file_size,
           CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'DUPLICATE' ELSE 'PENDING' END AS load_status
    FROM documents""")
def file_audit_status(t: Tables):
    return incremental.mark_duplicates(_listing(t), _file_log(t))


@query("map_columns", """
    SELECT 'HIS-CHN-' || c_custkey AS patient_id_src, upper(trim(c_name)) AS full_name,
           CAST(c_nationkey AS VARCHAR) AS city_code, CAST(c_acctbal AS DECIMAL(12,2))::DOUBLE AS balance_inr,
           CAST(NULL AS VARCHAR) AS blood_group
    FROM customer""")
def map_columns(t: Tables):
    mapped = mappings.map_columns(t.raw("customer"), [
        ("c_custkey", "patient_id_src", "string", lambda c: F.concat(F.lit("HIS-CHN-"), c.cast("string"))),
        ("c_name", "full_name", "string", lambda c: F.upper(F.trim(c))),
        ("c_nationkey", "city_code", "string"),
        ("c_acctbal", "balance_inr", "decimal(12,2)"),
        ("blood_group", "blood_group", "string"),
    ], absent_as_null=True)
    return mapped.withColumn("balance_inr", F.col("balance_inr").cast("double"))


@query("append_evolve", """
    SELECT c_custkey AS person_id, c_name AS name, c_mktsegment AS plan, CAST(NULL AS INTEGER) AS nation FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""")
def append_evolve(t: Tables):
    first = t.raw("customer").select(
        F.col("c_custkey").alias("person_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("plan"))
    later = t.raw("supplier").select(
        F.col("s_suppkey").alias("person_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return sinks.append_evolving(first, later)


@query("cdc_normalise", """
    SELECT event_id AS change_id, user_id AS drug_id,
           CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' WHEN 'view' THEN NULL ELSE 'u' END AS op,
           ts AS commit_ts
    FROM events""")
def cdc_normalise(t: Tables):
    code = (F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D")
            .when(F.col("event_type") == "view", "?").otherwise("U"))
    return t.raw("events").select(
        F.col("event_id").alias("change_id"), F.col("user_id").alias("drug_id"),
        cdc.normalise_op(code).alias("op"), F.col("ts").alias("commit_ts"))


@query("wm_lookup", """
    SELECT s_name AS entity_name,
           CASE WHEN s_acctbal > 0 THEN '2024-01-01 00:00:00' ELSE '1900-01-01 00:00:00' END AS last_watermark_value,
           CASE WHEN s_acctbal > 0 THEN s_suppkey ELSE 0 END AS records_processed,
           0 AS consecutive_failures
    FROM supplier""")
def wm_lookup(t: Tables):
    supplier = t.raw("supplier")
    control = supplier.filter(F.col("s_acctbal") > 0).select(
        F.col("s_name").alias("entity_name"), F.lit("2024-01-01 00:00:00").alias("last_watermark_value"),
        F.col("s_suppkey").alias("records_processed"), F.lit(0).alias("consecutive_failures"))
    return incremental.lookup_marks(supplier.select(F.col("s_name").alias("entity_name")), control)


@query("wm_filter", """
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-30 00:00:00'""")
def wm_filter(t: Tables):
    return incremental.after_mark(t.raw("orders"), "o_orderdate", "2000-06-30 00:00:00").select(
        "o_orderkey", "o_custkey", "o_orderdate")


@query("wm_lookback", """
    SELECT user_id, arg_max(event_id, event_id) AS event_id, max(ts) AS ts, arg_max(value, event_id) AS value
    FROM events WHERE ts > TIMESTAMP '2024-01-27 00:00:00' - INTERVAL 3 DAY GROUP BY user_id""")
def wm_lookback(t: Tables):
    events = t.raw("events").select("user_id", "event_id", "ts", "value")
    return incremental.with_lookback(events, "ts", "2024-01-27 00:00:00", ["user_id"], ["ts", "event_id"])


@query("wm_advance", """
    WITH result AS (
        SELECT o_custkey, count(*) AS n, max(o_orderdate) AS newest, arg_max(o_orderstatus, o_orderkey) AS last_status
        FROM orders GROUP BY o_custkey)
    SELECT c_name AS entity_name,
           CASE WHEN last_status <> 'F' AND newest > old_mark THEN CAST(newest AS VARCHAR) ELSE CAST(old_mark AS VARCHAR) END AS last_watermark_value,
           CAST(old_records + CASE WHEN last_status <> 'F' THEN n ELSE 0 END AS BIGINT) AS records_processed,
           CAST(CASE WHEN last_status <> 'F' THEN 0 WHEN last_status = 'F' THEN old_failures + 1 ELSE old_failures END AS INTEGER) AS consecutive_failures,
           CASE WHEN last_status IS NOT NULL THEN 'run-' || o_custkey WHEN known THEN 'none' END AS last_pipeline_run_id,
           CASE WHEN last_status <> 'F' THEN 0 WHEN last_status = 'F' THEN old_failures + 1 ELSE old_failures END >= 3 AS needs_attention
    FROM (SELECT *, c_custkey % 10 <> 0 AS known,
                 CASE WHEN c_custkey % 10 = 0 THEN TIMESTAMP '1900-01-01' WHEN c_custkey % 3 = 0 THEN TIMESTAMP '1998-07-01' ELSE TIMESTAMP '1995-01-01' END AS old_mark,
                 CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE c_nationkey END AS old_records,
                 CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE c_nationkey % 4 END AS old_failures FROM customer)
    LEFT JOIN result ON c_custkey = o_custkey
    WHERE known OR last_status IS NOT NULL""")
def wm_advance(t: Tables):
    customer = t.raw("customer")
    # Every tenth entity is not in the control table yet; every third has a mark most of its runs lie before.
    mark = F.when(F.col("c_custkey") % 3 == 0, "1998-07-01 00:00:00").otherwise("1995-01-01 00:00:00")
    control = customer.where("c_custkey % 10 <> 0").select(
        F.col("c_name").alias("entity_name"), mark.alias("last_watermark_value"),
        F.col("c_nationkey").cast("long").alias("records_processed"),
        (F.col("c_nationkey") % 4).alias("consecutive_failures"), F.lit("none").alias("last_pipeline_run_id"))
    orders = t.raw("orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    loaded = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("records"), F.max("o_orderdate").cast("string").alias("new_watermark"),
        F.max_by("o_orderstatus", "o_orderkey").alias("_last"))
    results = loaded.join(customer.select("c_custkey", F.col("c_name").alias("entity_name")),
                          F.col("c_custkey") == F.col("o_custkey")).select(
        "entity_name", F.when(F.col("_last") == "F", "FAILED").otherwise("SUCCESS").alias("load_status"),
        "new_watermark", "records", F.concat(F.lit("run-"), "o_custkey").alias("run_id"))
    return incremental.advance_marks(control, results)


@query("run_results", """
    SELECT o_orderpriority AS entity_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS run_month,
           count(*) AS records, CAST(max(o_orderdate) AS VARCHAR) AS new_watermark
    FROM orders GROUP BY ALL""")
def run_results(t: Tables):
    loaded = t.raw("orders").select(
        F.col("o_orderpriority").alias("entity_name"), F.trunc("o_orderdate", "month").alias("run_month"), "o_orderdate")
    return incremental.run_results(loaded, "entity_name", "run_month", "o_orderdate")


@query("load_date_delta", """
    SELECT admission_id, patient_id, hospital_code, admission_date FROM admissions WHERE admission_date = DATE '1999-03-15'""")
def load_date_delta(t: Tables):
    return incremental.load_date_delta(t.admissions, "1999-03-15", "admission_date").select(
        "admission_id", "patient_id", "hospital_code", "admission_date")


@query("trailing_interval", """
    SELECT event_id, event_ts, heart_rate FROM vitals
    WHERE event_ts >= TIMESTAMP '2024-01-31' - INTERVAL 1 DAY AND event_ts <= TIMESTAMP '2024-01-31'""")
def trailing_interval(t: Tables):
    return incremental.trailing(t.vitals, "event_ts", midnight("2024-01-31"), "1 day").select(
        "event_id", "event_ts", "heart_rate")


@query("dedup_latest", """
    SELECT user_id, event_id, ts, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1""")
def dedup_latest(t: Tables):
    events = t.raw("events").select("user_id", "event_id", "ts", "event_type")
    return latest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])
