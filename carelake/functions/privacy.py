"""Hashing, masking and redaction of personal data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: text that replaces an address.
REDACTED_ADDRESS = "[REDACTED_TO_CITY_LEVEL]"

# Column names that must not reach the reporting layer.
FORBIDDEN_COLUMNS = ["aadhaar_number", "ssn", "credit_card", "phone_number"]

# Patterns of personal data inside free text.
VALUE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\b[6-9][0-9]{9}\b",
    "identifier_12": r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b",
}

LEVELS = ("CRITICAL", "HIGH", "MEDIUM", "LOW")

# Text every match of a pattern must contain; rows without it skip the expression.
PATTERN_MARKS = {"email": "@"}


def hash_value(col: Column) -> Column:
    return F.sha2(col.cast("string"), 256)


def holds_pattern(col: Column, name: str, pattern: str) -> Column:
    """Whether the text holds a match of the named pattern."""
    found = col.rlike(pattern)
    return col.contains(PATTERN_MARKS[name]) & found if name in PATTERN_MARKS else found


def mask_phone_prefix(col: Column) -> Column:
    """All digits but the last four hidden, whatever stands before or between them: `9841012345` -> `XXXXXX2345`,
    `+91 98410 12345` -> `+XX XXXXX X2345`."""
    return F.regexp_replace(col, r"\d(?=(?:\D*\d){4})", "X")


def mask_phone_suffix(col: Column) -> Column:
    """Only the last four shown: `9876543210` -> `XXXXXX-3210`."""
    return F.concat(F.lit("XXXXXX-"), F.right(col, F.lit(4)))


def mask_email(col: Column) -> Column:
    """First and last character of the local part stay; a one-character local part is hidden whole."""
    return F.when(col.rlike(r"^[^@]@"), F.regexp_replace(col, r"^[^@]", "***")).otherwise(
        F.regexp_replace(col, r"^([^@])[^@]*([^@]@)", "$1***$2")
    )


def mask_card(col: Column) -> Column:
    """Digits of a card number after the twelfth shown, as one group, whether or not it is written in groups."""
    digits = F.regexp_replace(col, r"\D", "")
    return F.when(F.length(digits) > 12, F.concat(F.lit("XXXX-XXXX-XXXX-"), F.substr(digits, F.lit(13)))).otherwise(
        F.regexp_replace(col, r"\d", "X"))


def hash_identifier(df: DataFrame, raw: str = "aadhaar_number", hashed: str = "aadhaar_hash") -> DataFrame:
    """Replace an identifier by its hash; the raw column does not survive."""
    return df.withColumn(hashed, hash_value(F.col(raw))).drop(raw)


def hash_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Replace each listed column `c` by `c_hash`."""
    wanted = set(columns)
    return df.select(
        *[hash_value(F.col(c)).alias(f"{c}_hash") if c in wanted else F.col(c) for c in df.columns]
    )


def redact_address(df: DataFrame, column: str = "address") -> DataFrame:
    return df.withColumn(column, F.lit(REDACTED_ADDRESS))


def mask_by_policy(df: DataFrame, policy: Mapping[str, str], masks: Mapping[str, object] | None = None) -> DataFrame:
    """Apply a classification policy `{column: level}` in one projection.

    CRITICAL columns are hashed to `<c>_hash`, and so are HIGH columns without an entry in `masks`; other HIGH columns
    go through their mask. MEDIUM, LOW and unlisted columns are kept. An unknown level is an error.
    """
    masks = masks or {}
    unknown = {level for level in policy.values() if level.upper() not in LEVELS}
    if unknown:
        raise ValueError(f"unknown levels: {sorted(unknown)}")
    out = []
    for name in df.columns:
        level = policy.get(name, "LOW").upper()
        if level == "CRITICAL" or (level == "HIGH" and name not in masks):
            out.append(hash_value(F.col(name)).alias(f"{name}_hash"))
        elif level == "HIGH":
            out.append(masks[name](F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)
