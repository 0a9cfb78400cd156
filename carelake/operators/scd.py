"""Slowly changing dimensions without a MERGE statement: each function returns the whole new table.

The caller writes the result as a new version of the table (see `sources.sinks.replace_table`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.dates import in_interval
from carelake.functions.text import record_hash
from carelake.operators.ordered import latest_per_key

# Default tracked columns per dimension.
PATIENT_TRACKED = ["address_line1", "city", "pincode", "insurance_plan_id"]
PROVIDER_TRACKED = ["department_code", "hospital_code"]
CLAIM_TRACKED = ["status"]

VERSION_COLUMNS = ["eff_start_date", "eff_end_date", "is_current", "record_hash"]


def empty_dimension(delta: DataFrame) -> DataFrame:
    """Dimension without rows for a first load, so that loads need only one code path."""
    version = [
        T.StructField("eff_start_date", T.DateType()),
        T.StructField("eff_end_date", T.DateType()),
        T.StructField("is_current", T.IntegerType()),
        T.StructField("record_hash", T.StringType()),
    ]
    return delta.sparkSession.createDataFrame([], T.StructType([*delta.schema.fields, *version]))


def apply_type1(dim: DataFrame, delta: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite `columns` with the incoming values; keys without a delta stay, new keys are added."""
    incoming = delta.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = dim.join(incoming, key, "full_outer")
    out = [F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in dim.columns]
    return joined.select(*out)


def apply_type2(dim: DataFrame, delta: DataFrame, key: str, tracked: Sequence[str], as_of: Column) -> DataFrame:
    """Close changed current rows and open their successors; add first versions of new keys.

    `delta` holds one row per key. `as_of` may be a column of the delta (a submission date) or a literal.
    Keys missing from the delta stay as they are. Closed history is passed through without a shuffle.
    """
    history = dim.filter(F.col("is_current") == 0)
    current = dim.filter(F.col("is_current") == 1)
    incoming = delta.withColumns({"_hash": record_hash(*tracked), "_as_of": as_of})
    attributes = [c for c in dim.columns if c not in VERSION_COLUMNS]
    both = current.select(F.col(key), F.struct(*dim.columns).alias("_old")).join(
        incoming.select(F.col(key), "_as_of", "_hash", F.struct(*[
            F.col(c) if c in delta.columns else F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in attributes
        ]).alias("_new")),
        key, "full_outer")
    # NULL-safe throughout: one side is missing for untouched and for brand-new keys.
    changed = F.col("_new").isNotNull() & F.col("_old").isNotNull() & (F.col("_old.record_hash") != F.col("_hash"))
    opened = changed | F.col("_old").isNull()
    row_type = T.StructType([dim.schema[c] for c in dim.columns]).simpleString()
    kept = F.struct(*[
        F.when(changed, F.col("_as_of")).otherwise(F.col("_old.eff_end_date")).alias(c) if c == "eff_end_date"
        else F.when(changed, F.lit(0)).otherwise(F.col("_old.is_current")).alias(c) if c == "is_current"
        else F.col(f"_old.{c}").alias(c)
        for c in dim.columns])
    first = {
        "eff_start_date": F.col("_as_of"),
        "eff_end_date": F.lit(None).cast("date"),
        "is_current": F.lit(1),
        "record_hash": F.col("_hash"),
    }
    added = F.struct(*[(first[c] if c in first else F.col(f"_new.{c}")).alias(c) for c in dim.columns])
    rows = F.array_compact(F.array(
        F.when(F.col("_old").isNotNull(), kept.cast(row_type)),
        F.when(opened, added.cast(row_type)),
    ))
    touched = both.select(F.inline(rows))
    return history.select(*dim.columns).unionByName(touched)


def load_counts(dim: DataFrame, as_of: Column) -> DataFrame:
    """Brand-new keys, changed keys and rows after a load of the day, from one pass over the result."""
    opened = F.count_if((F.col("eff_start_date") == as_of) & (F.col("is_current") == 1))
    expired = F.count_if(F.col("eff_end_date") == as_of)
    return dim.agg((opened - expired).alias("new_keys"), expired.alias("expired_rows"), F.count(F.lit(1)).alias("total_rows"))


def apply_type3(dim: DataFrame, delta: DataFrame, key: str, column: str, as_of: Column) -> DataFrame:
    """Keep current and previous value: `current_<c>`, `previous_<c>`, `<c>_changed_at`.

    A key that only the delta has starts with its value as current and no previous one.
    """
    cur, prev, at = f"current_{column}", f"previous_{column}", f"{column}_changed_at"
    new = F.col("_incoming")
    old = dim.withColumn("_known", F.lit(True))
    joined = old.join(delta.select(F.col(key), F.col(column).alias("_incoming")), key, "full")
    fresh = F.col("_known").isNull()
    changed = ~fresh & new.isNotNull() & ~new.eqNullSafe(F.col(cur))
    return joined.withColumns({
        prev: F.when(changed, F.col(cur)).otherwise(F.col(prev)),
        at: F.when(changed, as_of).otherwise(F.col(at)),
        cur: F.when(changed | fresh, new).otherwise(F.col(cur)),
    }).select(*dim.columns)


def rebuild_type2(rows: DataFrame, key: str, tracked: Sequence[str], day: str, order: Sequence[str],
                  carried: Sequence[str] = ()) -> DataFrame:
    """Full version history from all bronze rows in one pass.

    The last row of a key and `day` counts. With a calendar day that leaves at most one row per key and day for the
    windows, whatever the number of source rows behind a key; with an event time as `day`, intervals start at the time
    and several changes of one day are all kept. `carried` columns come along untracked.
    """
    needed = dict.fromkeys([key, *tracked, *carried, day, *order])
    daily = latest_per_key(rows.select(*needed), [key, day], order)
    along = Window.partitionBy(key).orderBy(day)
    hashed = daily.withColumn("record_hash", record_hash(*tracked))
    before = F.lag("record_hash").over(along)
    starts = hashed.withColumn("_changed", before.isNull() | (before != F.col("record_hash"))).filter("_changed")
    ends = F.lead(day).over(along)
    return starts.select(
        F.col(key), *tracked, *carried,
        F.col(day).alias("eff_start_date"),
        ends.alias("eff_end_date"),
        F.when(ends.isNull(), 1).otherwise(0).alias("is_current"),
        "record_hash",
    )


def apply_type2_events(dim: DataFrame, events: DataFrame, key: str, tracked: Sequence[str], day: str,
                       order: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """Type 2 for dated events, several per key allowed (A -> B -> A gives three versions).

    The history of keys with events is rebuilt from its versions and the events, so late events find their
    place and applying the same events again changes nothing. All other keys are passed through; while the
    keys with events are few, their list is replicated and the dimension is not shuffled.
    """
    columns = [key, *tracked, *carried]
    touched = events.select(key).distinct()
    news = events.withColumn("_order", F.struct(*order))
    known = dim.join(touched, key, "left_semi").select(
        *columns, F.col("eff_start_date").alias(day), F.lit(0).alias("_age"),
        F.lit(None).cast(news.schema["_order"].dataType).alias("_order"))
    rows = known.unionByName(news.select(*columns, day, F.lit(1).alias("_age"), "_order"))
    rebuilt = rebuild_type2(rows, key, tracked, day, [day, "_age", "_order"], carried)
    untouched = dim.join(touched, key, "left_anti")
    return untouched.select(*columns, *VERSION_COLUMNS).unionByName(rebuilt.select(*columns, *VERSION_COLUMNS))


def snapshot(dim: DataFrame, day: str) -> DataFrame:
    """Rows valid on the given day."""
    return dim.filter(in_interval(F.lit(day).cast("date"), F.col("eff_start_date"), F.col("eff_end_date")))


def surrogate_key(key: str, start: str = "eff_start_date") -> Column:
    """Repeatable surrogate: the same version gets the same number in every run."""
    return F.xxhash64(F.col(key), F.col(start))
