"""Business days with holidays: a calendar that counts them once, and two lookups per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.operators.joins import join_dimension


def business_calendar(spark: SparkSession, first: str, last: str, holidays: DataFrame) -> DataFrame:
    """One row per `day` from first to last: `is_business_day`, `business_days` (how many there were so far, itself included).

    `holidays` has a column `day`; repeated ones, weekends and NULLs among them do no harm. The table is as long as the
    calendar, some tens of thousands of rows for a century.
    """
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    off = holidays.select(F.col("day").cast("date").alias("day")).distinct().withColumn("_off", F.lit(True))
    marked = days.join(off, "day", "left").withColumn(
        "is_business_day", (F.weekday("day") < 5) & F.col("_off").isNull()).drop("_off")
    return marked.withColumn("business_days", F.sum(F.col("is_business_day").cast("int")).over(Window.orderBy("day")).cast("int"))


def with_business_days(df: DataFrame, calendar: DataFrame, start: str, end: str, name: str) -> DataFrame:
    """Business days in (start, end]; negative, counted in (end, start], if the dates are reversed.

    NULL if a date is NULL or outside the calendar.
    """
    counts = calendar.select("day", "business_days")
    from_day = counts.select(F.col("day").alias(start), F.col("business_days").alias("_from"))
    to_day = counts.select(F.col("day").alias(end), F.col("business_days").alias("_to"))
    both = join_dimension(join_dimension(df, from_day, start), to_day, end)
    return both.withColumn(name, F.col("_to") - F.col("_from")).select(*df.columns, name)
