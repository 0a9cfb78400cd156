"""Stock alerts, transfers between hospitals, expiry and wastage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COVER_DAYS = 7
EXPIRY_DAYS = 30


def daily_use(consumption: DataFrame, keys: Sequence[str], quantity: str, days: Column | int) -> DataFrame:
    """Average use per day over a period of `days` days."""
    days = F.lit(days) if isinstance(days, int) else days
    used = F.sum(F.col(quantity).cast("decimal(18,2)")).cast("double")
    return consumption.groupBy(*keys).agg((used / days).alias("avg_daily_consumption"))


def stock_cover(stock: DataFrame, use: DataFrame, keys: Sequence[str], cover: int = COVER_DAYS) -> DataFrame:
    """Stock against its daily use: days left and whether it lasts `cover` days."""
    left = F.try_divide(F.col("current_stock"), F.col("avg_daily_consumption"))
    return stock.join(use, list(keys)).withColumns({
        "days_of_stock_remaining": F.round(left, 1),
        "is_short": F.col("current_stock") < F.col("avg_daily_consumption") * cover,
    })


def stockout_alerts(stock: DataFrame, use: DataFrame, keys: Sequence[str], cover: int = COVER_DAYS) -> DataFrame:
    return (
        stock_cover(stock, use, keys, cover).filter("is_short").drop("is_short")
        .withColumn("alert_type", F.lit("STOCKOUT_RISK"))
    )


def _givers_and_takers(cover: DataFrame, site: str, drug: str, keep_days: int) -> tuple[DataFrame, DataFrame]:
    spare = F.floor(F.col("current_stock") - F.col("avg_daily_consumption") * keep_days)
    givers = cover.withColumn("surplus_units", spare).filter("surplus_units > 0").select(
        drug, F.col(site).alias("from_site"), "surplus_units")
    need = F.ceil(F.col("avg_daily_consumption") * COVER_DAYS - F.col("current_stock"))
    takers = cover.filter("is_short").select(
        drug, F.col(site).alias("to_site"), need.alias("shortage_units"), "days_of_stock_remaining")
    return givers, takers


def transfer_suggestions(cover: DataFrame, drug: str, site: str, keep_days: int = 2 * COVER_DAYS) -> DataFrame:
    """For every short site of a drug, each site that can give without dropping below `keep_days` of cover.

    The pairs of one drug are bounded by the number of hospitals squared, not by the size of the data.
    """
    givers, takers = _givers_and_takers(cover, site, drug, keep_days)
    return takers.drop("days_of_stock_remaining").join(givers, drug).withColumn(
        "transfer_units", F.least("surplus_units", "shortage_units"))


def transfer_plan(cover: DataFrame, drug: str, site: str, keep_days: int = 2 * COVER_DAYS) -> DataFrame:
    """Which site sends how many units where, every spare unit promised once: `from_site`, `to_site`, `transfer_units`.

    The surplus of a drug's givers (largest first) and the shortage of its takers (fewest days left first) are laid end to
    end as two lines of units. Where a giver's stretch begins or a taker's does, the plan passes to the next one; a unit of the
    first line goes to the site it lies beside on the second. So nothing is sent beyond a surplus, and either every
    shortage is filled or every surplus is used up. One sorted pass over the sites of a drug, no pairs of them.
    """
    givers, takers = _givers_and_takers(cover, site, drug, keep_days)
    before = lambda units, *order: F.coalesce(F.sum(units).over(
        Window.partitionBy(drug).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    none = F.lit(None).cast("string")
    given = givers.select(drug, before("surplus_units", F.desc("surplus_units"), "from_site").alias("begin"), "from_site",
                          none.alias("to_site"), F.col("surplus_units").alias("given"), F.lit(0).cast("long").alias("taken"))
    taken = takers.select(drug, before("shortage_units", F.asc_nulls_first("days_of_stock_remaining"), "to_site").alias("begin"),
                          none.alias("from_site"), "to_site", F.lit(0).cast("long").alias("given"),
                          F.col("shortage_units").alias("taken"))
    whole = Window.partitionBy(drug)
    # At a border of both lines their rows meet in one: the next stretch of each begins there.
    borders = given.unionByName(taken).groupBy(drug, "begin").agg(
        F.max("from_site").alias("from_site"), F.max("to_site").alias("to_site"), F.sum("given").alias("given"), F.sum("taken").alias("taken"))
    along = whole.orderBy("begin")
    end = F.least(F.sum("given").over(whole), F.sum("taken").over(whole))
    placed = borders.select(
        drug, "begin", F.last("from_site", ignorenulls=True).over(along).alias("from_site"),
        F.last("to_site", ignorenulls=True).over(along).alias("to_site"),
        F.least(F.lead("begin").over(along), end).alias("until"), end.alias("end"))
    units = F.coalesce("until", "end") - F.col("begin")
    return placed.withColumn("transfer_units", units).filter("transfer_units > 0").select(
        drug, "from_site", "to_site", "transfer_units")


def near_expiry(stock: DataFrame, as_of: Column, days: int = EXPIRY_DAYS) -> DataFrame:
    """Stock that expires within `days` days from `as_of`."""
    left = F.datediff(F.col("expiry_date"), as_of)
    return stock.withColumn("days_to_expiry", left).filter(F.col("days_to_expiry").between(0, days))


def wastage_by_quarter(stock: DataFrame, as_of: Column, limit_pct: float = 1.0) -> DataFrame:
    """Share of inventory value that expired, per quarter of the expiry date."""
    value = F.col("stock_value").cast("decimal(18,2)")
    lost = F.sum(F.when(F.col("expiry_date") <= as_of, value).otherwise(0))
    rate = F.try_divide(lost.cast("double"), F.sum(value).cast("double")) * 100
    return stock.groupBy(F.date_trunc("quarter", "expiry_date").cast("date").alias("quarter")).agg(
        F.sum(value).alias("inventory_value"), lost.alias("expired_value"),
        F.round(rate, 4).alias("wastage_pct"), F.coalesce(rate > limit_pct, F.lit(False)).alias("breach"))
