"""Bronze to silver to gold as plain functions over DataFrames; one write per layer is left to the caller."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions import dates, privacy, text
from carelake.operators import audit, fraud, joins, kpi, lab, matching, pharmacy, quality, scd
from carelake.sources import sinks
from carelake.sources.readers import with_lineage

PATIENT_POLICY = {"aadhaar_number": "CRITICAL", "phone_number_raw": "HIGH", "email": "HIGH"}


def bronze_patients(raw: DataFrame, mark: str, run_id: str, loaded_at: Column) -> DataFrame:
    """New patient rows since the mark, with lineage."""
    fresh = raw.filter(F.col("updated_at") > F.lit(mark).cast("timestamp"))
    return with_lineage(fresh, "HIS-CHN", run_id, loaded_at)


def standardised(df: DataFrame, zone: str, keep_case: Sequence[str] = ()) -> DataFrame:
    """Silver rules in one projection: text trimmed and upper case, timestamps in UTC, NULL defaults."""
    out = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType) and field.name not in keep_case:
            out[field.name] = text.standardise(F.col(field.name))
        elif isinstance(field.dataType, T.TimestampType):
            out[field.name] = dates.to_utc(F.col(field.name), zone)
    return text.null_defaults(df.withColumns(out) if out else df)


def silver_patients(dim: DataFrame | None, bronze: DataFrame, load_date: str) -> DataFrame:
    """`dim_patient` after one load: newest row per patient, masked, typed version 2 history."""
    day = F.lit(load_date).cast("date")
    delta = scd.latest_per_key(bronze.filter(F.col("_load_date") == day), ["patient_id_src"], ["updated_at"])
    masked = delta.withColumn("phone_number", privacy.mask_phone_prefix(F.col("phone_number_raw")))
    rows = masked.select(
        F.col("patient_id_src").alias("global_patient_id"), "patient_id_src",
        F.col("_source_system").alias("src_system"), "first_name", "last_name", "date_of_birth", "gender",
        "phone_number", *scd.PATIENT_TRACKED, "blood_group", "aadhaar_hash")
    start = scd.empty_dimension(rows) if dim is None else dim
    return scd.apply_type2(start, rows, "global_patient_id", scd.PATIENT_TRACKED, day)


def with_global_ids(patients: DataFrame, ids: DataFrame) -> DataFrame:
    """Replace the source id by the matched id; a patient without one keeps the id it has."""
    matched = ids.select(F.col("record_id").alias("patient_id_src"), F.col("global_patient_id").alias("_matched"))
    return patients.join(matched, "patient_id_src", "left").withColumn(
        "global_patient_id", F.coalesce("_matched", "global_patient_id")).drop("_matched")


def match_patients(bronze: DataFrame) -> DataFrame:
    """Global ids from the bronze rows: the mask of the silver layer hides digits the match needs."""
    newest = scd.latest_per_key(bronze, ["patient_id_src"], ["updated_at"])
    fields = matching.match_fields(
        newest, "patient_id_src", "first_name", "last_name", "date_of_birth", "phone_number_raw", "aadhaar_hash")
    return matching.assign_global_ids(fields)


def gold(admissions: DataFrame, claims: DataFrame, vitals: DataFrame, discharges: DataFrame, labs: DataFrame | None = None,
         stock: DataFrame | None = None, use_days: int = 365) -> dict[str, DataFrame]:
    """Reporting tables: daily summary and fraud flags; laboratory turnaround and stock alerts where their sources are given.

    `stock` has one row per drug and hospital; its daily use is that of the claims over `use_days`.
    """
    made = {
        "kpi_daily_summary": kpi.daily_summary(admissions, claims, vitals),
        "fraud_flags": fraud.flags(fraud.flag_rules(claims, discharges, at_least=fraud.FLAG_SCORE)),
    }
    if labs is not None:
        made["lab_tat_summary"] = lab.turnaround_summary(
            labs.withColumn("summary_date", F.to_date("collected_ts")), ["summary_date", "hospital_code"],
            critical=lab.is_critical(F.col("test_code"), F.col("result_value")))
    if stock is not None:
        keys = ["drug_id", "hospital_code"]
        made["pharmacy_stock_alerts"] = pharmacy.stockout_alerts(stock, pharmacy.daily_use(claims, keys, "quantity", use_days), keys)
    return made


#: Columns every reporting table has to have, and the share of NULLs in percent from which a silver table stops the run.
REQUIRED = {
    "kpi_daily_summary": ["hospital_code", "kpi_date", "new_admissions", "readmission_rate_pct"],
    "fraud_flags": ["claim_id", "fraud_score", "flag_date"],
    "lab_tat_summary": ["summary_date", "hospital_code", "order_type", "p95_tat_hours"],
    "pharmacy_stock_alerts": ["drug_id", "hospital_code", "current_stock", "days_of_stock_remaining"],
}
KEY_NULLS_PCT = {
    "admissions": {"admission_id": 0.0, "patient_id": 0.0, "admission_date": 0.0},
    "claims": {"claim_id": 0.0, "patient_id": 1.0, "claim_amount": 5.0},
}


def silver_findings(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failed checks of the silver tables as (severity, message): NULL keys and claims without an admission; one scan a table."""
    parts = []
    for name, limits in KEY_NULLS_PCT.items():
        rates = quality.null_rates(tables[name], limits).where("not passed")
        parts.append(rates.select(F.lit("CRITICAL").alias("severity"), F.concat(
            F.lit(f"{name}."), "column_name", F.lit(" is NULL in "), F.col("null_count").cast("string"), F.lit(" rows")).alias("message")))
    lost = joins.orphans(tables["claims"], tables["admissions"], "admission_id").agg(F.sum("child_rows").alias("n")).where("n > 0")
    parts.append(lost.select(F.lit("WARNING").alias("severity"), F.concat(
        F.col("n").cast("string"), F.lit(" claims have no admission")).alias("message")))
    return reduce(DataFrame.unionByName, parts)


def gold_findings(made: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Findings from the columns of the reporting tables: personal data, missing ones, other ones than published. Reads no rows."""
    parts = []
    for name, df in made.items():
        parts += [quality.forbidden_columns(df, name), quality.missing_columns(df, REQUIRED.get(name, []), name)]
        path = f"{root}/{name}"
        if sinks.current_version(df.sparkSession, path) is not None:
            parts.append(quality.schema_drift(df, sinks.read_current(df.sparkSession, path).schema, name))
    return reduce(DataFrame.unionByName, parts).select("severity", "message")


def run_gold(root: str, silver: Mapping[str, DataFrame], run_id: str, clock: Callable[[], datetime], use_days: int = 365) -> DataFrame:
    """Check the silver tables, build, check and publish the reporting tables under `root`, and append the audit.

    Returns the audit rows of the run. Rows written are counted by the write itself. If the gate halts, nothing is
    published, one FAILED row says why, and the error goes on. `silver`: admissions, claims, vitals (graded) and discharges; labs and stock
    if there are any.
    """
    spark = silver["admissions"].sparkSession
    began = clock()

    def record(entity: str, rows: int, status: str = "SUCCESS", error: str | None = None) -> DataFrame:
        return audit.audit_record(
            spark, pipeline="gold_aggregation", job="gold", run_id=run_id, source="silver", entity=entity, read=rows, written=rows,
            rejected=0, status=status, start=began, end=clock(), error=error)

    made = gold(silver["admissions"], silver["claims"], silver["vitals"], silver["discharges"], silver.get("labs"),
                silver.get("stock"), use_days)
    try:
        quality.enforce(silver_findings(silver).unionByName(gold_findings(made, root)))
    except quality.GateHalted as halted:
        record("gate", 0, "FAILED", str(halted)).write.mode("append").parquet(f"{root}/audit")
        raise
    rows = []
    for name, df in made.items():
        seen = Observation()
        sinks.replace_table(published(df, run_id, F.lit(began)).observe(seen, F.count(F.lit(1)).alias("n")), f"{root}/{name}")
        rows.append(record(name, seen.get["n"]))
    done = reduce(DataFrame.unionByName, rows).coalesce(1)
    done.write.mode("append").parquet(f"{root}/audit")
    return done


def published(df: DataFrame, run_id: str, refreshed_at: Column) -> DataFrame:
    """Run columns added when a reporting table is written."""
    return df.withColumns({"pipeline_run_id": F.lit(run_id), "refreshed_at": refreshed_at.cast("timestamp")})
