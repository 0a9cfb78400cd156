"""Joins, aggregations and windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.catalog.bindings import Tables
from carelake.catalog.registry import query
from carelake.functions.dates import seconds_between
from carelake.functions.text import record_hash
from carelake.operators import aggregates, joins, kpi
from carelake.operators.scd import rebuild_type2
from carelake.operators.ordered import next_values
from carelake.streaming.parse import grade_vitals


def _hashed(t: Tables, plan):
    rows = t.patients.select("patient_id", "city", plan.alias("insurance_plan_id"))
    return rows.withColumn("record_hash", record_hash("city", "insurance_plan_id"))


@query("join_changed", """
    SELECT patient_id, city, 'UNINSURED' AS insurance_plan_id FROM patients WHERE balance < 0""")
def join_changed(t: Tables):
    current = _hashed(t, F.col("insurance_plan_id"))
    incoming = _hashed(t, F.when(F.col("balance") < 0, "UNINSURED").otherwise(F.col("insurance_plan_id")))
    changed = joins.changed_rows(
        incoming.withColumnRenamed("record_hash", "new_hash"), current, "patient_id", "new_hash", "record_hash")
    return changed.select("patient_id", "city", "insurance_plan_id")


@query("join_anti", """
    SELECT patient_id, global_patient_id FROM patients WHERE patient_id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def join_anti(t: Tables):
    seen = t.raw("orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("patient_id"))
    return t.patients.select("patient_id", "global_patient_id").join(seen, "patient_id", "left_anti")


@query("join_anti_composite", """
    SELECT DISTINCT admission_id, status FROM claims c
    WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = c.admission_id AND l.l_linestatus = 'F' AND
        CASE l.l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'R' THEN 'DENIED' WHEN 'N' THEN 'PENDING' END = c.status)""")
def join_anti_composite(t: Tables):
    claims = t.claims()
    known = claims.filter(F.col("payer_code") == "PAYER-F").select("admission_id", "status")
    return claims.select("admission_id", "status").distinct().join(known, ["admission_id", "status"], "left_anti")


@query("join_left", """
    WITH a AS (SELECT hospital_code, admission_date, count(*) AS admissions FROM admissions GROUP BY ALL),
    r AS (SELECT hospital_code, admission_date, count(*) AS urgent FROM admissions WHERE dept_code = '1-URGENT' GROUP BY ALL)
    SELECT hospital_code, admission_date, admissions, urgent FROM a LEFT JOIN r USING (hospital_code, admission_date)""")
def join_left(t: Tables):
    keys = ["hospital_code", "admission_date"]
    every = t.admissions.groupBy(*keys).agg(F.count(F.lit(1)).alias("admissions"))
    urgent = t.admissions.filter(F.col("dept_code") == "1-URGENT").groupBy(*keys).agg(F.count(F.lit(1)).alias("urgent"))
    return every.join(urgent, keys, "left")


@query("agg_join_back", """
    SELECT claim_id, physician_id, claim_date, count(*) OVER (PARTITION BY physician_id, claim_date) AS daily_proc_count FROM claims""")
def agg_join_back(t: Tables):
    claims = t.claims().select("claim_id", "physician_id", "claim_date")
    daily = claims.groupBy("physician_id", "claim_date").agg(F.count(F.lit(1)).alias("daily_proc_count"))
    return joins.join_summary(claims, daily, ["physician_id", "claim_date"], "inner").select("claim_id", "physician_id", "claim_date", "daily_proc_count")


@query("fk_orphans", """
    SELECT l_suppkey AS physician_id, count(*) AS child_rows FROM lineitem
    WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) GROUP BY l_suppkey""")
def fk_orphans(t: Tables):
    solvent = t.raw("supplier").filter(F.col("s_acctbal") >= 0).select(F.col("s_suppkey").alias("physician_id"))
    return joins.orphans(t.claims().select("physician_id"), solvent, "physician_id")


@query("scd2_asof_join", """
    SELECT c.claim_id, c.patient_id, c.claim_date, v.plan, v.eff_start_date
    FROM claims c LEFT JOIN versions v ON c.patient_id = v.patient_id AND v.eff_start_date <= c.claim_date
         AND (v.eff_end_date IS NULL OR c.claim_date < v.eff_end_date)""")
def scd2_asof_join(t: Tables):
    facts = t.claims(patient=True).select("claim_id", "patient_id", "claim_date")
    versions = plan_versions(t)
    newest = t.claims().agg(F.max("claim_date")).scalar()
    return joins.as_of_versions(facts, versions, "patient_id", "claim_date", horizon=newest).select(
        "claim_id", "patient_id", "claim_date", "plan", "eff_start_date")


def plan_events(t: Tables):
    """Plan of a patient by day, from their admissions."""
    return t.raw("orders").select(
        F.col("o_custkey").alias("patient_id"), F.col("o_orderpriority").alias("plan"),
        F.col("o_orderdate").cast("date").alias("d"), F.col("o_orderkey").alias("seq"))


def plan_versions(t: Tables):
    return rebuild_type2(plan_events(t), "patient_id", ["plan"], "d", ["d", "seq"])


@query("broadcast_dim_join", """
    SELECT claim_id, physician_id, s_name AS physician_name, status FROM claims LEFT JOIN supplier ON physician_id = s_suppkey""")
def broadcast_dim_join(t: Tables):
    physicians = t.raw("supplier").select(F.col("s_suppkey").alias("physician_id"), F.col("s_name").alias("physician_name"))
    return joins.join_dimension(t.claims(), physicians, "physician_id").select(
        "claim_id", "physician_id", "physician_name", "status")


@query("agg_admissions", """
    SELECT hospital_code, admission_date, count(*) AS new_admissions, count(discharge_date) AS discharges,
           avg(discharge_date - admission_date) AS avg_los_days
    FROM admissions GROUP BY hospital_code, admission_date""")
def agg_admissions(t: Tables):
    return kpi.admission_measures(t.admissions)


@query("agg_claims_status", """
    SELECT hospital_code, claim_date, count(*) AS claims_submitted, count(*) FILTER (status = 'APPROVED') AS claims_approved,
           count(*) FILTER (status = 'DENIED') AS claims_denied, CAST(sum(approved_amount) AS DOUBLE) AS revenue_inr
    FROM claims GROUP BY hospital_code, claim_date""")
def agg_claims_status(t: Tables):
    return kpi.claim_measures(t.claims()).withColumn("revenue_inr", F.col("revenue_inr").cast("double"))


@query("agg_vitals_daily", """
    SELECT hospital_code, CAST(event_ts AS DATE) AS vitals_date, avg(heart_rate) AS avg_heart_rate, avg(spo2) AS avg_spo2,
           count(*) FILTER (alert_level = 'CRITICAL') AS critical_alerts, count(*) FILTER (alert_level = 'WARNING') AS warning_alerts
    FROM graded GROUP BY ALL""")
def agg_vitals_daily(t: Tables):
    return kpi.vitals_measures(grade_vitals(t.vitals))


@query("readmission_rate", """
    SELECT count(*) AS admissions, CAST(sum(is_readmission) AS BIGINT) AS readmissions,
           round(sum(is_readmission) / count(*) * 100, 2) AS readmission_rate_pct
    FROM flagged_admissions""")
def readmission_rate(t: Tables):
    return kpi.readmission_rate(kpi.readmissions(t.admissions))


@query("physician_daily", """
    SELECT physician_id, claim_date, count(*) AS daily_proc_count FROM claims GROUP BY physician_id, claim_date""")
def physician_daily(t: Tables):
    return t.claims().groupBy("physician_id", "claim_date").agg(F.count("claim_id").alias("daily_proc_count"))


@query("p95_tat", """
    SELECT hospital_code, order_type, round(quantile_cont(tat_seconds, 0.95) / 3600, 6) AS p95_tat_hours
    FROM labs GROUP BY hospital_code, order_type""")
def p95_tat(t: Tables):
    p95 = aggregates.exact_percentile(t.labs, ["hospital_code", "order_type"], "tat_seconds", 0.95, "p95", width=600)
    return p95.select("hospital_code", "order_type", F.round(F.col("p95") / 3600, 6).alias("p95_tat_hours"))


@query("p95_tat_sketched", """
    SELECT hospital_code, order_type, CAST(date_trunc('week', collected_ts) AS DATE) AS week, count(*) AS n, true AS within_bound
    FROM labs GROUP BY ALL""")
def p95_tat_sketched(t: Tables):
    """Weekly percentiles from daily sketches; whether their rank among the rows is within the stated error."""
    labs = t.labs.withColumn("day", F.to_date("collected_ts"))
    daily = aggregates.percentile_sketches(labs, ["day", "hospital_code", "order_type"], "tat_seconds")
    week = F.date_trunc("week", "day").cast("date").alias("week")
    p95 = aggregates.sketched_percentile(daily, ["hospital_code", "order_type", week], 0.95, "p95")
    rows = labs.select("hospital_code", "order_type", week, "tat_seconds").join(p95, ["hospital_code", "order_type", "week"])
    share = lambda hit: F.count_if(hit) / F.count(F.lit(1))
    error = F.lit(aggregates.SKETCH_RANK_ERROR) + 1 / F.count(F.lit(1))  # one row more or less is no error
    return rows.groupBy("hospital_code", "order_type", "week").agg(
        F.max("n").alias("n"), ((share(F.col("tat_seconds") < F.col("p95")) <= 0.95 + error)
                                & (share(F.col("tat_seconds") <= F.col("p95")) >= 0.95 - error)).alias("within_bound"))


def _sets_sql(dims, body, view):
    label = " ".join(f"WHEN grouping({d}) = 0 THEN '{d}'" for d in dims)
    member = " ".join(f"WHEN grouping({d}) = 0 THEN CAST({d} AS VARCHAR)" for d in dims)
    sets = ", ".join(f"({d})" for d in dims)
    return (f"SELECT CASE {label} ELSE 'TOTAL' END AS dimension, CASE {member} END AS member, {body} "
            f"FROM {view} GROUP BY GROUPING SETS ({sets}, ())")


_DENIAL_DIMS = ["payer_code", "procedure_code", "hospital_code", "physician_id"]


@query("denial_grouping_sets", _sets_sql(
    _DENIAL_DIMS, "count(*) AS claims, count(*) FILTER (status = 'DENIED') AS denied, "
    "round(count(*) FILTER (status = 'DENIED') / count(*) * 100, 2) AS denial_rate_pct", "claims"))
def denial_grouping_sets(t: Tables):
    return kpi.denial_rates_by(t.claims(), _DENIAL_DIMS)


_READMIT_DIMS = ["dept_code", "physician_id", "diagnosis_code", "hospital_code"]


@query("readmit_grouping_sets", _sets_sql(
    _READMIT_DIMS, "count(*) AS admissions, CAST(sum(is_readmission) AS BIGINT) AS readmissions, "
    "round(sum(is_readmission) / count(*) * 100, 2) AS readmission_rate_pct",
    "(SELECT f.*, p.physician_id, p.diagnosis_code FROM flagged_admissions f LEFT JOIN (SELECT admission_id, "
    "arg_min(physician_id, claim_id) AS physician_id, arg_min(diagnosis_code, claim_id) AS diagnosis_code FROM claims "
    "GROUP BY admission_id) p USING (admission_id)) AS enriched"))
def readmit_grouping_sets(t: Tables):
    first = t.claims(diagnosis=True).groupBy("admission_id").agg(
        F.min_by(F.struct("physician_id", "diagnosis_code"), "claim_id").alias("c"))
    enriched = kpi.readmissions(t.admissions).join(first, "admission_id", "left").select(
        "*", "c.physician_id", "c.diagnosis_code")
    return kpi.readmission_rates_by(enriched, _READMIT_DIMS)


@query("run_health", """
    SELECT pipeline_name, status, count(*) AS runs FROM runs GROUP BY pipeline_name, status""")
def run_health(t: Tables):
    return t.runs.groupBy("pipeline_name", "status").agg(F.count(F.lit(1)).alias("runs"))


_COUNTED = ["customer", "supplier", "part", "orders", "lineitem", "events"]


@query("table_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _COUNTED))
def table_counts(t: Tables):
    counts = [t.raw(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for n in _COUNTED]
    return reduce(DataFrame.unionByName, counts)


@query("lag_discharge", """
    SELECT admission_id, patient_id, admission_date, prev_discharge, days_since_discharge FROM flagged_admissions""")
def lag_discharge(t: Tables):
    return kpi.with_previous_discharge(t.admissions).select(
        "admission_id", "patient_id", "admission_date", "prev_discharge", "days_since_discharge")


@query("count_7d_range", """
    SELECT claim_id, patient_id, procedure_code, claim_date,
           count(*) OVER (PARTITION BY patient_id, procedure_code ORDER BY claim_date
                          RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS proc_count_7d
    FROM claims""")
def count_7d_range(t: Tables):
    keys = ["patient_id", "procedure_code"]
    claims = t.claims(patient=True).select("claim_id", *keys, "claim_date")
    counts = aggregates.trailing_days(claims, keys, "claim_date", 7, "proc_count_7d")
    return joins.join_summary(claims, counts, [*keys, "claim_date"]).select("claim_id", *keys, "claim_date", "proc_count_7d")


@query("ytd_revenue", """
    WITH daily AS (SELECT claim_date, coalesce(sum(approved_amount), 0) AS revenue FROM claims GROUP BY claim_date)
    SELECT claim_date, CAST(revenue AS DOUBLE) AS revenue,
           CAST(sum(revenue) OVER (PARTITION BY year(claim_date) ORDER BY claim_date) AS DOUBLE) AS ytd_revenue
    FROM daily""")
def ytd_revenue(t: Tables):
    daily = t.claims().groupBy("claim_date").agg(
        F.coalesce(F.sum(kpi.money(F.col("approved_amount"))), F.lit(0)).alias("revenue"))
    out = aggregates.running_by_year(daily, "claim_date", "revenue", "ytd_revenue")
    return out.select("claim_date", *[F.col(c).cast("double").alias(c) for c in ("revenue", "ytd_revenue")])


@query("rolling_12m", """
    WITH monthly AS (
        SELECT hospital_code, CAST(date_trunc('month', claim_date) AS DATE) AS month, count(*) AS claims,
               count(*) FILTER (status = 'DENIED') AS denied FROM claims GROUP BY ALL),
    span AS (SELECT hospital_code, min(month) AS lo, max(month) AS hi FROM monthly GROUP BY hospital_code),
    spine AS (SELECT hospital_code, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM span),
    dense AS (SELECT hospital_code, month, coalesce(claims, 0) AS claims, coalesce(denied, 0) AS denied
              FROM spine LEFT JOIN monthly USING (hospital_code, month))
    SELECT hospital_code, month, claims, denied,
           CAST(sum(claims) OVER w AS BIGINT) AS claims_12m, CAST(sum(denied) OVER w AS BIGINT) AS denied_12m
    FROM dense WINDOW w AS (PARTITION BY hospital_code ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def rolling_12m(t: Tables):
    monthly = t.claims().groupBy("hospital_code", F.trunc("claim_date", "month").alias("month")).agg(
        F.count("claim_id").alias("claims"), F.count_if(F.col("status") == "DENIED").alias("denied"))
    return aggregates.rolling_months(
        monthly, ["hospital_code"], "month", {"claims_12m": "claims", "denied_12m": "denied"})


@query("status_duration", """
    SELECT event_id, user_id AS claim_no, event_type AS status, ts AS since,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS until,
           CAST(date_diff('second', date_trunc('second', ts), date_trunc('second', lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT) AS seconds_in_status
    FROM events""")
def status_duration(t: Tables):
    moves = t.raw("events").select(
        "event_id", F.col("user_id").alias("claim_no"), F.col("event_type").alias("status"), F.col("ts").alias("since"))
    out = next_values(moves, ["claim_no"], ["since", "event_id"], {"until": "since"})
    return out.withColumn("seconds_in_status", seconds_between(F.col("until"), F.col("since")))
