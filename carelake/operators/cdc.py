"""Change-data-capture: normalise, order, reduce and merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.ordered import latest_per_key

# Operation codes of the file feed and of the event feed.
OP_CODES = {"I": "c", "U": "u", "D": "d", "c": "c", "u": "u", "d": "d", "r": "r"}
UPSERTS = ["c", "u", "r"]


def normalise_op(col: Column) -> Column:
    pairs = [F.lit(x) for kv in OP_CODES.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), col)


def latest_changes(changes: DataFrame, key: str, order: Sequence[str] = ("ts_ms", "offset")) -> DataFrame:
    """Last change per key by commit order."""
    return latest_per_key(changes, [key], order)


def merge_changes(target: DataFrame, changes: DataFrame, key: str, columns: Sequence[str],
                  order: Sequence[str] = ("ts_ms", "offset")) -> DataFrame:
    """New version of `target` (`key`, `columns`, `_is_deleted`) after a batch of changes.

    The last change of a key decides. Upserts replace all columns; a delete only sets `_is_deleted`, and
    takes the image from the batch for a key that was created and deleted within it. Deletes of a key
    nobody has seen are ignored.
    """
    upsert = F.col("op").isin(*UPSERTS)
    rank = F.struct(*[F.col(c) for c in order])
    image = F.struct(*[F.col(c) for c in columns])
    last = changes.groupBy(key).agg(
        F.max_by(F.col("op"), rank).alias("_op"),
        F.max_by(F.when(upsert, image), F.when(upsert, rank)).alias("_image"),
    )
    gone = F.col("_op") == "d"
    merged = target.withColumn("_known", F.lit(True)).join(last, key, "full_outer")
    kept = merged.filter(F.col("_known").isNotNull() | F.col("_image").isNotNull())
    return kept.select(
        F.col(key),
        *[F.when(F.col("_image").isNotNull(), F.col(f"_image.{c}")).otherwise(F.col(c)).alias(c) for c in columns],
        F.when(F.col("_op").isNull(), F.col("_is_deleted")).otherwise(gone).alias("_is_deleted"),
    )


def inserts_only(changes: DataFrame) -> DataFrame:
    """Insert events, for append-only logs."""
    return changes.filter(F.col("op") == "c")
