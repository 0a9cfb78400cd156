"""Row-level business rules of the vitals, claims and laboratory feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.functions import text

# Amounts from which a claim is looked at.
HIGH_VALUE_CLAIM = 100000.0
DENIED_SCRUTINY = 50000.0


def _any(*conditions: Column) -> Column:
    found = conditions[0]
    for condition in conditions[1:]:
        found = found | condition
    return found


def vitals_severity(hr: Column, spo2: Column, systolic: Column, temp: Column) -> Column:
    """CRITICAL / WARNING / NORMAL; a missing reading never triggers a tier on its own."""
    critical = _any(hr < 45, hr > 130, spo2 < 90.0, systolic > 180, temp > 39.5)
    warning = _any(hr < 55, hr > 110, spo2 < 94.0, systolic > 160)
    return F.when(critical, "CRITICAL").when(warning, "WARNING").otherwise("NORMAL")


def vitals_quality(hr: Column, spo2: Column, systolic: Column, mrn: Column, device: Column) -> Column:
    """Two-valued row check: an unknown outcome is a failure, so valid + rejected = input."""
    ok = (
        hr.between(20, 300)
        & spo2.between(70.0, 100.0)
        & systolic.between(50, 250)
        & mrn.isNotNull()
        & device.isNotNull()
    )
    return F.coalesce(ok, F.lit(False))


def vitals_impossible(hr: Column, spo2: Column, temp: Column) -> Column:
    """Physically impossible readings."""
    return F.coalesce(_any(hr < 10, hr > 400, spo2 < 20.0, temp < 25.0), F.lit(False))


def claim_quality(claim_id: Column, mrn: Column, amount: Column, status: Column, hospital: Column) -> Column:
    ok = (
        claim_id.isNotNull()
        & mrn.isNotNull()
        & (amount > 0)
        & status.isin(*text.STREAM_CLAIM_STATUSES)
        & hospital.isin(*text.HOSPITAL_CODES)
    )
    return F.coalesce(ok, F.lit(False))


def approval_ratio(approved: Column, amount: Column) -> Column:
    return F.when(amount > 0, approved / amount)


def is_high_value(amount: Column) -> Column:
    return amount > HIGH_VALUE_CLAIM


def is_fraud_risk(status: Column, amount: Column) -> Column:
    return (status == "DENIED") & (amount > DENIED_SCRUTINY)


def rate_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage, NULL when the denominator is zero."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """Quotient with the reporting convention: zero when it is not defined."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))
