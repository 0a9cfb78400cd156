"""Consent, erasure, retention and row-level access."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.joins import join_dimension

# Years until rows move to the archive and until they are deleted, per layer.
RETENTION_YEARS = {"bronze": (3, 7), "silver": (3, 7), "gold": (3, None), "audit": (None, 10)}
LANDING_DAYS = 14


def with_consent(df: DataFrame, consents: DataFrame, key: str) -> DataFrame:
    """Rows of subjects whose consent is given."""
    return df.join(consents.filter("consent").select(key), key, "left_semi")


def erase(tables: Mapping[str, DataFrame], subjects: DataFrame, key: str) -> dict[str, DataFrame]:
    """Every table without the rows of the subjects; the caller writes them as new versions."""
    gone = subjects.select(key)
    return {name: df.join(gone, key, "left_anti") for name, df in tables.items()}


def retention_class(day: Column, as_of: Column, layer: str) -> Column:
    """KEEP, ARCHIVE or DELETE by age under the rule of the layer."""
    archive, delete = RETENTION_YEARS[layer]
    out = F.lit("KEEP")
    if archive is not None:
        out = F.when(day <= F.add_months(as_of, -12 * archive), "ARCHIVE").otherwise(out)
    if delete is not None:
        out = F.when(day <= F.add_months(as_of, -12 * delete), "DELETE").otherwise(out)
    return out


def split_by_retention(df: DataFrame, day: str, as_of: Column, layer: str) -> dict[str, DataFrame]:
    """One frame per class, as plain date filters that reach the scan."""
    archive, delete = RETENTION_YEARS[layer]
    first = F.add_months(as_of, -12 * (archive or delete))
    last = F.add_months(as_of, -12 * (delete or 0)) if delete is not None else None
    kept = df.filter(F.col(day).isNull() | (F.col(day) > first))
    old = df.filter(F.col(day) <= first)
    if archive is None:
        return {"KEEP": kept, "ARCHIVE": df.limit(0), "DELETE": old}
    if last is None:
        return {"KEEP": kept, "ARCHIVE": old, "DELETE": df.limit(0)}
    return {"KEEP": kept, "ARCHIVE": old.filter(F.col(day) > last), "DELETE": df.filter(F.col(day) <= last)}


def visible_rows(df: DataFrame, mapping: DataFrame, user: str) -> DataFrame:
    """Rows of the hospitals mapped to the user."""
    own = mapping.filter(F.col("user_name") == user).select("hospital_code")
    return join_dimension(df, own, "hospital_code", "left_semi")
