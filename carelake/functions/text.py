"""Text cleansing, code mapping and format checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted code sets.
GENDERS = {"M": "Male", "F": "Female", "O": "Other"}
HOSPITAL_CODES = ["CHN", "MDU", "CBE", "TRV"]
HOSPITAL_NAMES = {"Chennai": "CHN", "Madurai": "MDU", "Coimbatore": "CBE", "Trivandrum": "TRV"}
BLOOD_GROUPS = ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"]
BATCH_CLAIM_STATUSES = ["SUBMITTED", "IN_REVIEW", "APPROVED", "DENIED", "PAID"]
STREAM_CLAIM_STATUSES = ["PENDING", "APPROVED", "DENIED", "PARTIAL"]
NULL_MARK = "∅"


def clean_header(name: str) -> str:
    """Column name without byte-order mark and outer blanks."""
    return name.replace("﻿", "").strip()


def snake_header(name: str) -> str:
    """`Employee ID` -> `employee_id`."""
    kept = "".join(c if c.isalnum() else " " for c in clean_header(name))
    return "_".join(kept.lower().split())


def standardise(col: Column) -> Column:
    return F.upper(F.trim(col))


def prefixed_key(prefix: str, col: Column) -> Column:
    """Source-prefixed business key; NULL stays NULL."""
    return F.concat(F.lit(prefix), col.cast("string"))


def map_code(col: Column, codes: Mapping[str, str], default: Column | None = None) -> Column:
    """Code lookup over a fixed map; unknown codes give `default` (NULL when not set)."""
    pairs = [F.lit(x) for kv in codes.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), col)
    return found if default is None else F.coalesce(found, default)


def strip_hospital_prefix(col: Column) -> Column:
    """`GROUP-CHN` -> `CHN`."""
    return F.regexp_replace(col, r"^[A-Z]+-", "")


def is_pincode(col: Column) -> Column:
    return F.coalesce(col.rlike(r"^\d{6}$"), F.lit(False))


def is_one_of(col: Column, accepted: Iterable[str]) -> Column:
    return F.coalesce(col.isin(*accepted), F.lit(False))


def null_defaults(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NULL strings become `UNKNOWN`, NULL integers -1; other types are left alone."""
    wanted = set(columns or df.columns)
    fill: dict[str, str | int] = {}
    for field in df.schema.fields:
        if field.name not in wanted:
            continue
        if isinstance(field.dataType, T.StringType):
            fill[field.name] = "UNKNOWN"
        elif isinstance(field.dataType, (T.IntegerType, T.LongType, T.ShortType)):
            fill[field.name] = -1
    return df.fillna(fill)


def record_hash(*columns: str) -> Column:
    """SHA-256 over tracked columns; NULL has its own mark so that shifted NULLs do not collide."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def join_codes(col: Column) -> Column:
    """Array of codes as one `|`-delimited string; NULL array stays NULL."""
    return F.array_join(col, "|")
