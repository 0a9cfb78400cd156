"""Laboratory turnaround and critical values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.dates import seconds_between
from carelake.operators.aggregates import exact_percentile
from carelake.operators.alerts import breach
from carelake.operators.joins import join_dimension, join_summary, literal_table

# Turnaround limits in hours per order type.
SLA_HOURS = {"STAT": 1.0, "ROUTINE": 4.0}

# Fixed values: (test code, operator, threshold) of results that need attention at once.
CRITICAL_VALUES = [
    ("POTASSIUM", ">", 6.5),
    ("TROPONIN", ">", 0.40),
    ("HEMOGLOBIN", "<", 6.0),
    ("PT_INR", ">", 5.0),
    ("GLUCOSE", "<", 40.0),
]
FLAG_SECONDS = 15 * 60


def turnaround_seconds(collected: str, released: str) -> Column:
    return seconds_between(F.col(released), F.col(collected))


def sla_hours(order_type: Column) -> Column:
    pairs = [F.lit(x) for kv in SLA_HOURS.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), order_type), F.lit(SLA_HOURS["ROUTINE"]))


def is_critical(test: Column, value: Column, limits=None) -> Column:
    """Whether a result is beyond the critical threshold of its test."""
    hits = [(test == F.lit(code)) & breach(value, F.lit(op), F.lit(limit)) for code, op, limit in limits or CRITICAL_VALUES]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))


def turnaround_summary(labs: DataFrame, by: Sequence[str], order_type: str = "order_type",
                       critical: Column | None = None) -> DataFrame:
    """Tests, average and 95th percentile turnaround in hours, SLA breaches and critical values per group.

    `labs` carries `tat_seconds`. Average and breaches are plain partial aggregates; the percentile is
    exact and does not hold a group's values in one task (ten-minute bands, at most 600 whole seconds each).
    """
    keys = list(dict.fromkeys([*by, order_type]))
    late = F.col("tat_seconds") > sla_hours(F.col(order_type)) * 3600
    base = labs.groupBy(*keys).agg(
        F.count("tat_seconds").alias("total_tests"),
        F.round(F.avg("tat_seconds") / 3600, 6).alias("avg_tat_hours"),
        F.count_if(late).alias("sla_breaches"),
        F.count_if(F.lit(False) if critical is None else critical).alias("critical_values_flagged"),
    )
    p95 = exact_percentile(labs, keys, "tat_seconds", 0.95, "_p95", width=600)
    return join_summary(base, p95, keys).withColumn("p95_tat_hours", F.round(F.col("_p95") / 3600, 6)).drop("_p95")


def breaches_by_shift(labs: DataFrame, dept: str, collected: str, order_type: str = "order_type") -> DataFrame:
    """SLA breaches per department and shift (morning from 06, evening from 14, night from 22)."""
    hour = F.hour(collected)
    shift = F.when((hour >= 6) & (hour < 14), "MORNING").when((hour >= 14) & (hour < 22), "EVENING").otherwise("NIGHT")
    late = F.col("tat_seconds") > sla_hours(F.col(order_type)) * 3600
    return labs.groupBy(dept, shift.alias("shift")).agg(
        F.count(F.lit(1)).alias("total_tests"), F.count_if(late).alias("sla_breaches"))


def critical_results(labs: DataFrame, test: str, value: str, limits=None) -> DataFrame:
    """Results beyond the critical threshold of their test; the threshold table is literal."""
    table = literal_table(labs.sparkSession, limits or CRITICAL_VALUES, f"{test} string, operator string, threshold double")
    joined = join_dimension(labs, table, test, "inner")
    return joined.filter(breach(F.col(value), F.col("operator"), F.col("threshold"))).drop("operator")


def flagged_in_time(critical: DataFrame, released: str, flagged: str, by: Sequence[str]) -> DataFrame:
    """Share of critical results flagged within 15 minutes of release."""
    return within(critical, released, flagged, FLAG_SECONDS, by, "critical_results", "flagged_in_time")


def within(df: DataFrame, start: str, end: str, limit_seconds: int, by: Sequence[str], total: str, hits: str) -> DataFrame:
    """Rows per group whose end follows the start within the limit, and their share in percent."""
    quick = F.count_if(seconds_between(F.col(end), F.col(start)) <= limit_seconds)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias(total), quick.alias(hits),
        F.round(F.try_divide(quick, F.count(F.lit(1))) * 100, 2).alias("in_time_pct"))
