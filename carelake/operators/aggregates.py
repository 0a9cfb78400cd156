"""Aggregations beyond a single groupBy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.operators.joins import join_summary


def grouping_totals(df: DataFrame, dims: Sequence[str], measures: Sequence[Column]) -> DataFrame:
    """Each dimension on its own plus the grand total, in one pass (GROUPING SETS).

    `dimension` names the grouped column, `member` holds its value as text (NULL in the total).
    """
    sets = [[F.col(d)] for d in dims] + [[]]
    grouped = df.groupingSets(sets, *[F.col(d) for d in dims]).agg(
        F.grouping_id(*dims).alias("_gid"), *measures
    )
    width = len(dims)
    label = F.lit("TOTAL")
    member = F.lit(None).cast("string")
    for i, d in enumerate(dims):
        bit = F.col("_gid").bitwiseAND(F.lit(1 << (width - 1 - i))) == 0
        label = F.when(bit, F.lit(d)).otherwise(label)
        member = F.when(bit, F.col(d).cast("string")).otherwise(member)
    names = [c for c in grouped.columns if c not in dims and c != "_gid"]
    return grouped.select(label.alias("dimension"), member.alias("member"), *names)


def percentile_sketches(df: DataFrame, by: Sequence[str], value: str, k: int = 800) -> DataFrame:
    """One KLL sketch of a whole-number column per group: `sketch`, a few kilobytes whatever the rows.

    With k = 800 the rank of a quantile is off by less than `SKETCH_RANK_ERROR` of the rows (99 % of sketches by half of it).
    """
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), k).alias("sketch"))


#: Largest error of a sketched quantile's rank, as a share of the rows; merging sketches does not add to it.
SKETCH_RANK_ERROR = 0.01


def sketched_percentile(sketches: DataFrame, by: Sequence[str | Column], p: float, name: str) -> DataFrame:
    """Percentile of any coarser groups (a month of days, all hospitals) from their sketches, without the rows: `n`, `name`."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    keys = [c for c in merged.columns if c != "sketch"]
    return merged.select(*keys, F.kll_sketch_get_n_bigint("sketch").alias("n"),
                         F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias(name))


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, p: float, name: str, width: float) -> DataFrame:
    """Interpolated percentile per key, exact, without holding a key's values in one task.

    Equal values are counted first. The counts per value band (`width` wide) of a key tell which bands hold
    the two neighbours of the wanted rank; only those bands are then ranked value by value.
    """
    keys = list(keys)
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_band", F.floor(F.col("_v") / F.lit(width)))
    )
    per_key = Window.partitionBy(*keys)
    bands = (
        counted.groupBy(*keys, "_band")
        .agg(F.sum("_n").alias("_bn"))
        .withColumn("_below", F.sum("_bn").over(per_key.orderBy("_band")) - F.col("_bn"))
        .withColumn("_rank", (F.sum("_bn").over(per_key) - 1) * F.lit(p))
        .withColumn("_lo", F.floor("_rank"))
        .withColumn("_hi", F.ceil("_rank"))
    )
    end = F.col("_below") + F.col("_bn")
    wanted = bands.filter((F.col("_below") <= F.col("_hi")) & (F.col("_lo") < end))
    in_band = Window.partitionBy(*keys, "_band").orderBy("_v")
    ranked = (
        join_summary(counted, wanted, [*keys, "_band"], "inner")
        .withColumn("_end", F.col("_below") + F.sum("_n").over(in_band))
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )

    def at(position: str) -> Column:
        pos = F.col(position)
        return F.max(F.when((F.col("_start") <= pos) & (pos < F.col("_end")), F.col("_v")))

    return (
        ranked.groupBy(*keys)
        .agg(at("_lo").alias("_a"), at("_hi").alias("_b"), F.max(F.col("_rank") - F.col("_lo")).alias("_f"))
        .select(*keys, (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")).alias(name))
    )


def trailing_days(df: DataFrame, keys: Sequence[str], day: str, days: int, name: str) -> DataFrame:
    """Rows per (keys, day) and the count over the trailing `days` calendar days, the day included.

    The rows are counted per day first, so a key contributes at most one row per calendar day to the window.
    """
    keys = list(keys)
    window = (
        Window.partitionBy(*keys).orderBy(F.unix_date(F.col(day))).rangeBetween(-(days - 1), 0)
    )
    daily = df.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("_day_rows"))
    return daily.withColumn(name, F.sum("_day_rows").over(window)).drop("_day_rows")


def month_spine(df: DataFrame, keys: Sequence[str], month: str) -> DataFrame:
    """Every month between a key's first and last one, so that gaps become rows."""
    span = df.groupBy(*keys).agg(F.min(month).alias("_from"), F.max(month).alias("_to"))
    return span.select(*keys, F.explode(F.sequence("_from", "_to", F.expr("interval 1 month"))).alias(month))


def rolling_months(monthly: DataFrame, keys: Sequence[str], month: str, sums: dict[str, str], months: int = 12) -> DataFrame:
    """Rolling sums over `months` calendar months; a month without rows counts as zero."""
    dense = month_spine(monthly, keys, month).join(monthly, [*keys, month], "left")
    window = Window.partitionBy(*keys).orderBy(month).rowsBetween(-(months - 1), 0)
    filled = dense.fillna(0, subset=list(sums.values()))
    return filled.withColumns({new: F.sum(src).over(window) for new, src in sums.items()})


def running_by_year(daily: DataFrame, day: str, value: str, name: str) -> DataFrame:
    """Year-to-date total over one row per day."""
    window = Window.partitionBy(F.year(day)).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn(name, F.sum(value).over(window))
