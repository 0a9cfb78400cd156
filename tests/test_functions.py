import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from carelake.functions import clinical, dates, privacy, text


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v")).alias("r")).first()["r"]


def test_headers():
    assert text.clean_header("﻿OrderID ") == "OrderID"
    assert text.snake_header("Employee ID") == "employee_id"


@pytest.mark.parametrize("raw, expected", [
    ("15-06-1978", dt.date(1978, 6, 15)), ("05-25-2024", dt.date(2024, 5, 25)),
    ("05-06-2024", dt.date(2024, 6, 5)), ("xx", None), (None, None)])
def test_two_date_formats(spark, raw, expected):
    assert one(spark, raw, dates.parse_day_first) == expected


@pytest.mark.parametrize("start, end, expected", [
    ("2024-01-05", "2024-01-08", 1), ("2024-01-06", "2024-01-07", 0), ("2024-01-01", "2024-01-15", 10),
    ("2024-01-03", "2024-01-03", 0), ("1969-12-26", "1970-01-02", 5)])
def test_business_days(spark, start, end, expected):
    df = spark.createDataFrame([(start, end)], "a string, b string")
    got = df.select(dates.business_days(F.col("a").cast("date"), F.col("b").cast("date")).alias("n")).first()["n"]
    assert got == expected


@pytest.mark.parametrize("fn, raw, expected", [
    (privacy.mask_phone_prefix, "9841012345", "XXXXXX2345"),
    (privacy.mask_phone_suffix, "9876543210", "XXXXXX-3210"),
    (privacy.mask_email, "arjun.patel@gmail.com", "a***l@gmail.com"),
    (privacy.mask_email, "priya@clinic.in", "p***a@clinic.in"),
    (privacy.mask_email, "ab@x.in", "a***b@x.in"),
    (privacy.mask_card, "4000123412341234", "XXXX-XXXX-XXXX-1234")])
def test_masks(spark, fn, raw, expected):
    assert one(spark, raw, fn) == expected


def test_short_email_is_hidden(spark):
    assert one(spark, "a@x.in", privacy.mask_email) == "***@x.in"


def test_hash_identifier_drops_the_raw_value(spark):
    df = privacy.hash_identifier(spark.createDataFrame([("512345678901",)], "aadhaar_number string"))
    assert df.columns == ["aadhaar_hash"]
    assert df.first()[0] == hashlib.sha256(b"512345678901").hexdigest()


def test_record_hash_keeps_nulls_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert df.select(text.record_hash("x", "y", "z")).distinct().count() == 2


def test_null_defaults_by_type(spark):
    df = spark.createDataFrame([(None, None, None)], "s string, i int, d double")
    assert tuple(text.null_defaults(df).first()) == ("UNKNOWN", -1, None)


def test_unknown_code_is_null(spark):
    assert one(spark, "X", lambda c: text.map_code(c, text.GENDERS)) is None
    assert one(spark, "M", lambda c: text.map_code(c, text.GENDERS)) == "Male"


def test_hospital_prefix(spark):
    assert one(spark, "GROUP-CHN", text.strip_hospital_prefix) == "CHN"
    assert one(spark, "CHN", text.strip_hospital_prefix) == "CHN"


def test_rates_without_denominator(spark):
    row = spark.createDataFrame([(1, 0)], "a int, b int").select(
        clinical.rate_pct(F.col("a"), F.col("b")).alias("gold"),
        clinical.ratio_or_zero(F.col("a"), F.col("b")).alias("report")).first()
    assert (row["gold"], row["report"]) == (None, 0.0)


@pytest.mark.parametrize("hr, spo2, bp, temp, level", [
    (44, 98.0, 120, 37.0, "CRITICAL"), (80, 89.9, 120, 37.0, "CRITICAL"), (80, 98.0, 181, 37.0, "CRITICAL"),
    (80, 98.0, 120, 39.6, "CRITICAL"), (54, 98.0, 120, 37.0, "WARNING"), (80, 93.9, 120, 37.0, "WARNING"),
    (80, 98.0, 161, 37.0, "WARNING"), (80, 98.0, 120, 37.0, "NORMAL"), (None, 98.0, 120, 37.0, "NORMAL"),
    (None, 85.0, None, None, "CRITICAL")])
def test_severity(spark, hr, spo2, bp, temp, level):
    df = spark.createDataFrame([(hr, spo2, bp, temp)], "hr int, s double, bp int, t double")
    assert df.select(clinical.vitals_severity(*[F.col(c) for c in df.columns])).first()[0] == level


def test_policy_masking(spark):
    df = spark.createDataFrame([("1", "700011112222", "9000054321", "x", "a@b.example")],
                               "id string, aadhaar string, phone string, name string, email string")
    policy = {"aadhaar": "CRITICAL", "phone": "HIGH", "name": "MEDIUM", "email": "HIGH"}
    out = privacy.mask_by_policy(df, policy, {"phone": privacy.mask_phone_prefix})
    assert out.columns == ["id", "aadhaar_hash", "phone", "name", "email_hash"]  # no mask of its own: hashed
    assert out.first()["phone"] == "XXXXXX4321"
    with pytest.raises(ValueError, match="SECRET"):
        privacy.mask_by_policy(df, {"name": "SECRET"})


@pytest.mark.parametrize("raw, masked", [
    ("9000054321", "XXXXXX4321"), ("+91 90000 54321", "+XX XXXXX X4321"), ("+919000054321", "+XXXXXXXX4321"), ("123", "123"), (None, None)])
def test_phone_digits_are_counted(spark, raw, masked):
    assert spark.createDataFrame([(raw,)], "p string").select(privacy.mask_phone_prefix(F.col("p"))).first()[0] == masked


@pytest.mark.parametrize("raw, masked", [
    ("4000700080009000", "XXXX-XXXX-XXXX-9000"), ("4000 7000 8000 9000", "XXXX-XXXX-XXXX-9000"),
    ("4000-7000-8000-9000", "XXXX-XXXX-XXXX-9000"), ("4000 7000", "XXXX XXXX"), (None, None)])
def test_card_groups(spark, raw, masked):
    assert spark.createDataFrame([(raw,)], "p string").select(privacy.mask_card(F.col("p"))).first()[0] == masked
