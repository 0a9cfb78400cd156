"""Reporting-layer measures: admissions, readmissions, claims, vitals and their daily summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions.clinical import rate_pct, ratio_or_zero
from carelake.functions.dates import business_days, days_between
from carelake.operators.aggregates import grouping_totals
from carelake.operators.joins import join_dimension
from carelake.operators.ordered import previous_values

READMISSION_DAYS = 30
DENIAL_LIMIT_PCT = 8.0
PENDING_DAYS = 30
MONEY = "decimal(18,2)"


def money(col: Column) -> Column:
    """Exact money type, so that sums do not depend on the order of rows."""
    return col.cast(MONEY)


def with_previous_discharge(admissions: DataFrame) -> DataFrame:
    """Previous discharge of the patient by admission date, and the days since."""
    out = previous_values(admissions, ["patient_id"], ["admission_date", "admission_id"],
                          {"prev_discharge": "discharge_date"})
    return out.withColumn("days_since_discharge", days_between(F.col("admission_date"), F.col("prev_discharge")))


def readmissions(admissions: DataFrame, days: int = READMISSION_DAYS) -> DataFrame:
    """Flag admissions that follow a discharge of the same patient within `days` days."""
    again = F.col("days_since_discharge").between(0, days)
    return with_previous_discharge(admissions).withColumn("is_readmission", F.when(again, 1).otherwise(0))


def admission_measures(admissions: DataFrame, by: Sequence[str] = ("hospital_code", "admission_date")) -> DataFrame:
    """Admissions, discharges and average stay; open stays do not enter the average."""
    return admissions.groupBy(*by).agg(*_admission_aggs())


def _admission_aggs() -> list[Column]:
    return [
        F.count("admission_id").alias("new_admissions"),
        F.count("discharge_date").alias("discharges"),
        F.avg(days_between(F.col("discharge_date"), F.col("admission_date"))).alias("avg_los_days"),
    ]


def claim_measures(claims: DataFrame, by: Sequence[str] = ("hospital_code", "claim_date")) -> DataFrame:
    """Claims by outcome and the approved revenue."""
    return claims.groupBy(*by).agg(
        F.count("claim_id").alias("claims_submitted"),
        F.count_if(F.col("status") == "APPROVED").alias("claims_approved"),
        F.count_if(F.col("status") == "DENIED").alias("claims_denied"),
        F.sum(money(F.col("approved_amount"))).alias("revenue_inr"),
    )


def vitals_measures(vitals: DataFrame) -> DataFrame:
    """Average readings and alert counts per hospital and day."""
    return vitals.groupBy("hospital_code", F.to_date("event_ts").alias("vitals_date")).agg(
        F.avg("heart_rate").alias("avg_heart_rate"),
        F.avg("spo2").alias("avg_spo2"),
        F.count_if(F.col("alert_level") == "CRITICAL").alias("critical_alerts"),
        F.count_if(F.col("alert_level") == "WARNING").alias("warning_alerts"),
    )


SUMMARY_COUNTS = ["readmission_count", "claims_submitted", "claims_approved", "claims_denied",
                  "critical_alerts", "warning_alerts"]


def daily_summary(admissions: DataFrame, claims: DataFrame, vitals: DataFrame) -> DataFrame:
    """One row per hospital and admission day.

    Admissions and readmissions come from one aggregate over the flagged rows; claims and vitals are reduced
    to the same grain before they are joined. Missing counts and sums are zero, missing averages stay NULL.
    """
    flagged = readmissions(admissions)
    base = flagged.groupBy("hospital_code", F.col("admission_date").alias("kpi_date")).agg(
        *_admission_aggs(), F.sum("is_readmission").alias("readmission_count"))
    money_side = claim_measures(claims).withColumnRenamed("claim_date", "kpi_date")
    vital_side = vitals_measures(vitals).withColumnRenamed("vitals_date", "kpi_date")
    on = ["hospital_code", "kpi_date"]
    joined = base.join(money_side, on, "left").join(vital_side, on, "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in SUMMARY_COUNTS}
        | {"revenue_inr": F.coalesce(F.col("revenue_inr"), F.lit(0).cast(MONEY))}
    ).withColumns({
        "readmission_rate_pct": rate_pct(F.col("readmission_count"), F.col("new_admissions")),
        "denial_rate_pct": rate_pct(F.col("claims_denied"), F.col("claims_submitted")),
    })


def full_summary(summary: DataFrame, admissions: DataFrame, icu: DataFrame, flagged: DataFrame) -> DataFrame:
    """Daily summary with patients, ICU beds and fraud flags of the hospital and day.

    `icu` comes from `icu_utilisation`, `flagged` holds (hospital_code, flag_date) of flagged claims.
    """
    on = ["hospital_code", "kpi_date"]
    patients = admissions.groupBy("hospital_code", F.col("admission_date").alias("kpi_date")).agg(
        F.countDistinct("patient_id").alias("total_patients"))
    fraud = flagged.groupBy("hospital_code", F.col("flag_date").alias("kpi_date")).agg(
        F.count(F.lit(1)).alias("fraud_flags_count"))
    beds = icu.select(*on, "icu_beds_occupied", "icu_beds_total", "icu_utilization_pct")
    return (
        summary.join(patients, on, "left").join(beds, on, "left").join(fraud, on, "left")
        .withColumn("fraud_flags_count", F.coalesce("fraud_flags_count", F.lit(0)))
    )


def readmission_rate(flagged: DataFrame) -> DataFrame:
    """Readmission share over all admissions."""
    return flagged.agg(
        F.count("admission_id").alias("admissions"),
        F.sum("is_readmission").alias("readmissions"),
        rate_pct(F.sum("is_readmission"), F.count("admission_id")).alias("readmission_rate_pct"),
    )


def readmission_rates_by(flagged: DataFrame, dims: Sequence[str]) -> DataFrame:
    return grouping_totals(flagged, dims, [
        F.count("admission_id").alias("admissions"),
        F.sum("is_readmission").alias("readmissions"),
        rate_pct(F.sum("is_readmission"), F.count("admission_id")).alias("readmission_rate_pct"),
    ])


def denial_rates_by(claims: DataFrame, dims: Sequence[str]) -> DataFrame:
    denied = F.count_if(F.col("status") == "DENIED")
    return grouping_totals(claims, dims, [
        F.count("claim_id").alias("claims"), denied.alias("denied"),
        rate_pct(denied, F.count("claim_id")).alias("denial_rate_pct"),
    ])


def denial_rate(claims: DataFrame, by: Sequence[str], limit: float = DENIAL_LIMIT_PCT) -> DataFrame:
    """Denial rate per group and whether it breaks the limit."""
    denied = F.count_if(F.col("status") == "DENIED")
    rate = F.try_divide(denied, F.count("claim_id")) * 100
    return claims.groupBy(*by).agg(
        F.count("claim_id").alias("claims"), denied.alias("denied"), F.round(rate, 2).alias("denial_rate_pct"),
        (rate > limit).alias("breach"))


def claims_at_risk(claims: DataFrame, as_of: Column, days: int = PENDING_DAYS) -> DataFrame:
    """Claims still pending after `days` days."""
    age = days_between(as_of, F.col("claim_date"))
    open_claims = claims.filter(F.col("status").isin("PENDING", "SUBMITTED", "IN_REVIEW"))
    return open_claims.withColumn("days_pending", age).filter(F.col("days_pending") > days)


def claim_turnaround(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumn("tat_business_days", business_days(F.col(start), F.col(end)))


def icu_utilisation(vitals: DataFrame, beds: DataFrame, limit: float = 90.0) -> DataFrame:
    """Occupied distinct beds per hospital and day against the bed count of the hospital."""
    occupied = vitals.groupBy("hospital_code", F.to_date("event_ts").alias("kpi_date")).agg(
        F.countDistinct("device_id").alias("icu_beds_occupied"))
    joined = occupied.join(beds, "hospital_code")
    rate = F.try_divide(F.col("icu_beds_occupied"), F.col("icu_beds_total")) * 100
    return joined.withColumns({"icu_utilization_pct": F.round(rate, 2), "breach": rate > limit})


def beds_at_a_time(stays: DataFrame, unit: str, start: str, end: str, until: str) -> DataFrame:
    """Beds in use per unit and day, from the first admission to the day `until`: `peak`, `mean` over time, `admissions`.

    A sweep over admissions (+1) and discharges (-1). Changes of one instant count together; a stay without an end goes on;
    a stay that ends no later than it starts, or has no start, takes no bed. Changes are summed per unit and instant
    before any window, the beds at midnight follow from the net changes of whole days, and the running sum starts anew with
    each day, so no window holds more than the instants of a day or the days of a unit.
    """
    valid = stays.filter(F.col(unit).isNotNull() & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    changes = valid.select(unit, F.inline(F.array(
        F.struct(F.col(start).alias("at"), F.lit(1).alias("change"), F.lit(1).alias("came")),
        F.struct(F.col(end).alias("at"), F.lit(-1).alias("change"), F.lit(0).alias("came"))))).where("at IS NOT NULL")
    days = changes.where("came = 1").groupBy(unit).agg(F.min("at").cast("date").alias("first"))
    midnights = days.select(unit, F.explode(F.sequence("first", F.greatest("first", F.lit(until).cast("date")))).alias("day")).select(
        unit, F.col("day").cast(stays.schema[start].dataType).alias("at"), F.lit(0).alias("change"), F.lit(0).alias("came"))
    points = changes.unionByName(midnights).groupBy(unit, "at").agg(F.sum("change").alias("change"), F.sum("came").alias("came"))
    points = points.withColumn("day", F.col("at").cast("date")).filter(F.col("day") <= F.lit(until).cast("date"))
    daily = points.groupBy(unit, "day").agg(F.sum("change").alias("net"))
    earlier = Window.partitionBy(unit).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    opening = daily.select(unit, "day", F.coalesce(F.sum("net").over(earlier), F.lit(0)).alias("opening"))
    inside = Window.partitionBy(unit, "day").orderBy("at")
    seconds = lambda at: F.unix_micros(at.cast("timestamp"))
    following = F.coalesce(F.lead("at").over(inside), F.date_add("day", 1).cast(stays.schema[start].dataType))
    runs = points.select(unit, "day", "came", F.sum("change").over(inside).alias("beds"),
                         (seconds(following) - seconds(F.col("at"))).alias("micros"))
    return runs.join(opening, [unit, "day"]).groupBy(unit, "day").agg(
        F.max(F.col("beds") + F.col("opening")).alias("peak"),
        F.round(F.sum((F.col("beds") + F.col("opening")) * F.col("micros")) / 86_400_000_000, 6).alias("mean"),
        F.sum("came").alias("admissions"))


def rate_per_1000(df: DataFrame, by: Sequence[str], hit: Column, name: str = "rate_per_1000") -> DataFrame:
    """Events per thousand rows: medication errors, infections, adverse events."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(hit).alias("events"),
        F.round(F.try_divide(F.count_if(hit) * 1000, F.count(F.lit(1))), 2).alias(name))


def stay_against_benchmark(admissions: DataFrame, benchmark: DataFrame, key: str) -> DataFrame:
    """Average stay per group and its difference from the benchmark of the group."""
    stays = admissions.groupBy(key).agg(
        F.count("discharge_date").alias("stays"),
        F.avg(days_between(F.col("discharge_date"), F.col("admission_date"))).alias("avg_los_days"))
    return join_dimension(stays, benchmark, key).withColumn(
        "variance_days", F.round(F.col("avg_los_days") - F.col("benchmark_days"), 4))


def bi_measures(flagged: DataFrame, claims: DataFrame) -> DataFrame:
    """Report measures per hospital; an undefined ratio is zero."""
    adm = flagged.groupBy("hospital_code").agg(
        F.sum("is_readmission").alias("_re"), F.count("admission_id").alias("_adm"))
    fin = claims.groupBy("hospital_code").agg(
        F.count_if(F.col("status") == "DENIED").alias("_den"), F.count("claim_id").alias("_cl"),
        F.sum(money(F.col("approved_amount"))).alias("revenue_inr"))
    return adm.join(fin, "hospital_code", "full_outer").select(
        "hospital_code",
        F.round(ratio_or_zero(F.col("_re"), F.col("_adm")), 6).alias("readmission_rate"),
        F.round(ratio_or_zero(F.col("_den"), F.col("_cl")), 6).alias("claims_denial_rate"),
        F.coalesce("revenue_inr", F.lit(0).cast(MONEY)).alias("revenue_inr"))
