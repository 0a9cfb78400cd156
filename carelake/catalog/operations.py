"""Audit, SLA, failure streaks and lineage."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from carelake.catalog.bindings import Tables
from carelake.catalog.registry import query
from carelake.operators import audit
from carelake.operators.joins import literal_table
from carelake.session import use_checkpoint_dir
from carelake.streaming.parse import grade_vitals


@query("audit_counts", """
    SELECT hospital_code, CAST(event_ts AS DATE) AS run_date, count(*) AS records_read, count(*) FILTER (dq_passed) AS records_written,
           count(*) FILTER (NOT dq_passed) AS records_rejected
    FROM graded GROUP BY ALL""")
def audit_counts(t: Tables):
    routed = grade_vitals(t.vitals).withColumn("run_date", F.to_date("event_ts"))
    return audit.route_counts(routed, "dq_passed", ["hospital_code", "run_date"])


@query("audit_observed", """
    SELECT 'vitals' AS entity_name, count(*) AS records_read, count(*) FILTER (dq_passed) AS records_written,
           count(*) FILTER (NOT dq_passed) AS records_rejected, 'SUCCESS' AS status
    FROM graded""")
def audit_observed(t: Tables):
    """Counts taken by the write itself."""
    path = f"{use_checkpoint_dir(t.spark)}/vitals-{uuid.uuid4().hex}"
    at = datetime(2024, 1, 31)
    row = audit.audited_write(grade_vitals(t.vitals), path, "dq_passed", pipeline="vitals", job="vitals", run_id="run",
                              source="ICU", entity="vitals", start=at, clock=lambda: at)
    return row.select("entity_name", "records_read", "records_written", "records_rejected", "status")


@query("lineage_trace", """
    WITH bronze AS (SELECT date_trunc('month', o_orderdate)::DATE AS m, count(*) AS n FROM orders GROUP BY ALL),
    silver AS (SELECT date_trunc('month', admission_date)::DATE AS m, count(*) AS n FROM admissions WHERE discharge_date IS NOT NULL GROUP BY ALL),
    gold AS (SELECT date_trunc('month', admission_date)::DATE AS m, count(DISTINCT (hospital_code, admission_date)) AS n FROM admissions GROUP BY ALL)
    SELECT 'run-' || strftime(coalesce(b.m, s.m, g.m), '%Y-%m') AS _run_id, coalesce(b.n, 0) AS bronze_rows, coalesce(s.n, 0) AS silver_rows, coalesce(g.n, 0) AS gold_rows
    FROM bronze b FULL OUTER JOIN silver s ON b.m = s.m FULL OUTER JOIN gold g ON coalesce(b.m, s.m) = g.m""")
def lineage_trace(t: Tables):
    run = F.concat(F.lit("run-"), F.date_format("admission_date", "yyyy-MM")).alias("_run_id")
    bronze = t.admissions.select(run, "admission_id")
    silver = t.admissions.filter(F.col("discharge_date").isNotNull()).select(run, "admission_id")
    gold = t.admissions.select(run, "hospital_code", "admission_date").distinct()
    return audit.trace({"bronze": bronze, "silver": silver, "gold": gold})


_SLA = [("1-URGENT", 1000), ("2-HIGH", 2000), ("3-MEDIUM", 3000)]


@query("sla_misses", """
    SELECT run_id, pipeline_name, duration_seconds, CAST(coalesce(s.sla, 3600) AS INTEGER) AS sla_seconds
    FROM runs LEFT JOIN (VALUES ('1-URGENT', 1000), ('2-HIGH', 2000), ('3-MEDIUM', 3000)) AS s(pipeline_name, sla) USING (pipeline_name)
    WHERE duration_seconds > coalesce(s.sla, 3600)""")
def sla_misses(t: Tables):
    budgets = literal_table(t.spark, _SLA, "pipeline_name string, sla_seconds int")
    return audit.over_budget(t.runs, budgets).select("run_id", "pipeline_name", "duration_seconds", "sla_seconds")


@query("failure_streaks", """
    WITH marked AS (
        SELECT pipeline_name, run_date, status, sum(CASE WHEN status = 'FAILED' THEN 0 ELSE 1 END) OVER (PARTITION BY pipeline_name ORDER BY run_date, run_id) AS island FROM runs)
    SELECT pipeline_name, min(run_date) AS first_failure, max(run_date) AS last_failure, count(*) AS failures
    FROM marked WHERE status = 'FAILED' GROUP BY pipeline_name, island HAVING count(*) >= 3""")
def failure_streaks(t: Tables):
    return audit.failure_streaks(t.runs, "pipeline_name", ["run_date", "run_id"], at_least=3)
