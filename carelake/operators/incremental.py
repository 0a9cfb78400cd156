"""Watermarks, lookback, file de-duplication and control-table updates.

Control tables hold one row per entity or file log entry; results are new versions of those tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.ordered import latest_per_key

# Fixed value: mark of an entity that was never loaded.
FIRST_MARK = "1900-01-01 00:00:00"
FAILURES_BEFORE_ALERT = 3


def lookup_marks(entities: DataFrame, control: DataFrame) -> DataFrame:
    """Mark per requested entity; the sentinel where the control table has none."""
    return entities.join(control, "entity_name", "left").withColumns({
        "last_watermark_value": F.coalesce("last_watermark_value", F.lit(FIRST_MARK)),
        "records_processed": F.coalesce("records_processed", F.lit(0)),
        "consecutive_failures": F.coalesce("consecutive_failures", F.lit(0)),
    })


def after_mark(df: DataFrame, column: str, mark: str) -> DataFrame:
    """Rows strictly newer than the mark. The literal has the column's type, so the scan can skip files."""
    return df.filter(F.col(column) > F.lit(mark).cast(df.schema[column].dataType))


def with_lookback(df: DataFrame, column: str, mark: str, keys: Sequence[str], order: Sequence[str],
                  days: int = 3) -> DataFrame:
    """Re-read the last `days` days before the mark for late rows and keep the newest row per key."""
    since = F.lit(mark).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    return latest_per_key(df.filter(F.col(column) > since), keys, order)


def run_results(loaded: DataFrame, entity: str, run: str, updated_at: str) -> DataFrame:
    """One row per entity and run: rows loaded and the newest `updated_at` among them."""
    return loaded.groupBy(entity, run).agg(
        F.count(F.lit(1)).alias("records"), F.max(updated_at).cast("string").alias("new_watermark")
    )


def advance_marks(control: DataFrame, results: DataFrame) -> DataFrame:
    """Apply one run result per entity `(entity_name, load_status, new_watermark, records, run_id)`.

    Success moves the mark forward (a late or repeated run never moves it back), adds the rows and clears the
    failures. Failure only counts up. An entity the control table does not have yet starts from the first mark.
    `needs_attention` marks entities at three failures in a row.
    """
    ran = F.col("load_status").isNotNull()
    ok = F.col("load_status") == "SUCCESS"
    before = F.coalesce("last_watermark_value", F.lit(FIRST_MARK))
    stamp = lambda c: F.try_to_timestamp(c)
    forward = F.col("new_watermark").isNotNull() & (stamp(F.col("new_watermark")) > stamp(before))
    failures = F.coalesce("consecutive_failures", F.lit(0))
    out = control.join(results, "entity_name", "full").withColumns({
        "last_watermark_value": F.when(ok & forward, F.col("new_watermark")).otherwise(before),
        "records_processed": F.coalesce("records_processed", F.lit(0))
        + F.when(ok, F.coalesce("records", F.lit(0))).otherwise(0),
        "consecutive_failures": F.when(ok, 0).when(ran, failures + 1).otherwise(failures),
        "last_pipeline_run_id": F.when(ran, F.col("run_id")).otherwise(F.col("last_pipeline_run_id")),
    })
    out = out.withColumn("needs_attention", F.col("consecutive_failures") >= FAILURES_BEFORE_ALERT)
    return out.select(*control.columns, "needs_attention")


def load_date_delta(df: DataFrame, run_date: str, column: str = "_load_date") -> DataFrame:
    """Rows landed on the run date; on the bronze layout this prunes to one partition."""
    return df.filter(F.col(column) == F.lit(run_date).cast("date"))


def trailing(df: DataFrame, column: str, as_of: Column, length: str) -> DataFrame:
    """Rows of the interval `length` (for example `1 hour`) that ends at `as_of`."""
    return df.filter((F.col(column) >= as_of - F.expr(f"interval {length}")) & (F.col(column) <= as_of))


def new_files(listing: DataFrame, log: DataFrame) -> DataFrame:
    """Files of the listing that have not been loaded before."""
    done = log.filter(F.col("load_status") == "SUCCESS").select("source_system", "filename").distinct()
    return listing.join(done, ["source_system", "filename"], "left_anti")


def mark_duplicates(listing: DataFrame, log: DataFrame) -> DataFrame:
    """Listing with status PENDING, or DUPLICATE for files loaded before."""
    done = (
        log.filter(F.col("load_status") == "SUCCESS")
        .select("source_system", "filename").distinct().withColumn("_seen", F.lit(True))
    )
    return (
        listing.join(done, ["source_system", "filename"], "left")
        .withColumn("load_status", F.when(F.col("_seen"), "DUPLICATE").otherwise("PENDING"))
        .drop("_seen")
    )
