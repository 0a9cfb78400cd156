"""Threshold rules and short alert texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (alert id, metric, operator, threshold, severity).
KPI_RULES = [
    ("ALT-011", "readmission_rate_pct", ">", 5.0, "WARNING"),
    ("ALT-012", "denial_rate_pct", ">", 8.0, "WARNING"),
    ("ALT-015", "fraud_score", ">=", 5.0, "CRITICAL"),
    ("ALT-016", "icu_utilization_pct", ">", 90.0, "CRITICAL"),
]


def breach(value: Column, operator: Column, threshold: Column) -> Column:
    return F.coalesce(
        F.when(operator == ">", value > threshold)
        .when(operator == ">=", value >= threshold)
        .when(operator == "<", value < threshold)
        .when(operator == "<=", value <= threshold),
        F.lit(False))


def threshold_alerts(df: DataFrame, entity: Sequence[str], rules=None) -> DataFrame:
    """One alert row per row and broken rule. Rules without a matching column are skipped."""
    own = [r for r in (rules or KPI_RULES) if r[1] in df.columns]
    checks = [F.struct(
        F.lit(r[0]).alias("alert_id"), F.lit(r[4]).alias("severity"), F.lit(r[1]).alias("metric"),
        F.col(r[1]).cast("double").alias("metric_value"), F.lit(r[2]).alias("operator"), F.lit(float(r[3])).alias("threshold"),
    ) for r in own]
    rows = df.select(*entity, F.inline(F.array(*checks)))
    return rows.filter(breach(F.col("metric_value"), F.col("operator"), F.col("threshold"))).drop("operator")


def sample_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first `n` rows by a full ordering: each task keeps `n` rows, no global sort."""
    return df.orderBy(*order).limit(n)


def sample_text(sample: DataFrame, order: Sequence[Column], text: Column, name: str = "message") -> DataFrame:
    """The sampled rows as one `; `-joined message."""
    ordered = sample.select(F.struct(*order, text.alias("_text")).alias("_row"))
    return ordered.agg(
        F.concat_ws("; ", F.transform(F.array_sort(F.collect_list("_row")), lambda r: r["_text"])).alias(name))
