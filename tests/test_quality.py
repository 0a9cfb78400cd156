import datetime as dt
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.operators.joins import literal_table
from carelake.operators import aggregates, alerts, audit, governance, incremental, quality


def test_null_rates_with_group(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, "y"), (4, "z")], "a int, b string")
    out = {r["column_name"]: r for r in quality.null_rates(df, {"a": 30.0, "b": 10.0}, {"any": ["a", "b"]}).collect()}
    assert (out["a"]["null_count"], out["a"]["null_rate_pct"], out["a"]["passed"]) == (1, 25.0, True)
    assert not out["b"]["passed"]
    assert out["any"]["null_count"] == 2


def test_null_rates_of_an_empty_table(spark):
    row = quality.null_rates(spark.createDataFrame([], "a int"), {"a": 5.0}).first()
    assert (row["total_records"], row["null_rate_pct"], row["passed"]) == (0, 0.0, True)


RULE = [{"table": "t", "column": "a", "rule_name": "positive", "condition": "a > 0", "severity": "CRITICAL"}]


@pytest.mark.parametrize("strict, failed", [(False, 1), (True, 2)])
def test_rules_and_unknown_outcomes(spark, strict, failed):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "a int")
    assert quality.apply_rules({"t": df}, RULE, strict).first()["failed_count"] == failed


def test_gate_halts_on_critical(spark):
    bad = spark.createDataFrame([("WARNING", "w"), ("CRITICAL", "c")], "severity string, message string")
    row = quality.gate(bad).first()
    assert (row["verdict"], row["worst_severity"], row["issues"], row["first_issues"]) == ("HALT", "CRITICAL", 2, "c; w")
    with pytest.raises(quality.GateHalted):
        quality.enforce(bad)


def test_gate_passes_warnings_and_nothing(spark):
    warn = spark.createDataFrame([("WARNING", str(i)) for i in range(7)], "severity string, message string")
    row = quality.gate(warn).first()
    assert (row["verdict"], row["issues"], row["first_issues"]) == ("PASS", 7, "0; 1; 2; 3; 4")
    empty = quality.gate(warn.limit(0)).first()
    assert (empty["verdict"], empty["worst_severity"], empty["issues"]) == ("PASS", "NONE", 0)
    quality.enforce(warn)


def test_missing_column_is_critical(spark):
    df = spark.createDataFrame([(1,)], "OrderID int")
    found = quality.missing_columns(df, ["OrderID", "TestCode"], "labs").collect()
    assert [(r["column_name"], r["severity"]) for r in found] == [("TestCode", "CRITICAL")]


def test_schema_drift(spark):
    df = spark.createDataFrame([(1, "x")], "a int, c string")
    registered = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    found = {r["column_name"]: r["message"] for r in quality.schema_drift(df, registered, "t").collect()}
    assert found == {"a": "type string became int", "b": "removed", "c": "added as string"}


def test_forbidden_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "phone_number int, aadhaar_hash int, aadhaar_last4 int, total int")
    assert {r["column_name"] for r in quality.forbidden_columns(df, "gold").collect()} == {"phone_number", "aadhaar_last4"}


def test_value_scan(spark):
    df = spark.createDataFrame([("call 9841012345",), ("a.b@x.in and c@y.in",), ("5123 4567 8901",), (None,)], "t string")
    got = {r["pattern"]: r["hits"] for r in quality.value_scan(df, "docs").collect()}
    assert got == {"email": 1, "phone": 1, "identifier_12": 1}


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    row = quality.key_duplicates(df, ["k"]).first()
    assert (row["total_rows"], row["distinct_keys"], row["duplicated_keys"], row["surplus_rows"], row["passed"]) == (3, 2, 1, 1, False)


def test_row_count_drop(spark):
    rows = [(dt.date(2024, 1, 1),)] * 10 + [(dt.date(2024, 1, 2),)] * 8 + [(dt.date(2024, 1, 3),)] * 2
    df = spark.createDataFrame(rows, "d date").withColumn("t", F.lit("x"))
    out = quality.row_count_drops(df, ["t"], "d").collect()
    assert [(r["d"], r["drop_pct"]) for r in out] == [(dt.date(2024, 1, 3), 75.0)]


def test_ratio_breach(spark):
    df = spark.createDataFrame([(16, 10), (10, 10), (1, 0)], "s int, b int")
    out = quality.count_ratio(df, "s", "b").collect()
    assert [(r["ratio_breach"], r["reconciled"]) for r in out] == [(True, False), (False, True), (False, False)]


CONTROL = "entity_name string, last_watermark_value string, records_processed long, consecutive_failures int, last_pipeline_run_id string"


def test_unknown_entity_gets_the_sentinel(spark):
    control = spark.createDataFrame([("a", "2024-01-01 00:00:00", 5, 0, "r")], CONTROL)
    out = {r["entity_name"]: r["last_watermark_value"] for r in incremental.lookup_marks(
        spark.createDataFrame([("a",), ("b",)], "entity_name string"), control).collect()}
    assert out == {"a": "2024-01-01 00:00:00", "b": "1900-01-01 00:00:00"}


def test_advance_marks(spark):
    m0, m1, early = "2024-02-01 00:00:00", "2024-02-02 06:00:00", "2024-01-01 00:00:00"
    control = spark.createDataFrame([(n, m0, 5, f, "r0") for n, f in (("ok", 2), ("bad", 2), ("idle", 1), ("empty", 0), ("late", 0))], CONTROL)
    results = spark.createDataFrame(
        [("ok", "SUCCESS", m1, 7, "r1"), ("bad", "FAILED", m1, 1, "r1"), ("empty", "SUCCESS", None, 0, "r1"),
         ("late", "SUCCESS", early, 2, "r1"), ("new", "SUCCESS", m1, 3, "r1"), ("new_bad", "FAILED", m1, 3, "r1")],
        "entity_name string, load_status string, new_watermark string, records long, run_id string")
    got = {r["entity_name"]: tuple(r)[1:] for r in incremental.advance_marks(control, results).collect()}
    assert got == {
        "ok": (m1, 12, 0, "r1", False), "bad": (m0, 5, 3, "r1", True), "idle": (m0, 5, 1, "r0", False),
        "empty": (m0, 5, 0, "r1", False), "late": (m0, 7, 0, "r1", False),  # the mark does not move back
        "new": (m1, 3, 0, "r1", False), "new_bad": ("1900-01-01 00:00:00", 0, 1, "r1", False)}


def test_mark_is_exclusive_and_lookback_reads_late_rows(spark):
    at = dt.datetime(2024, 1, 10)
    rows = [("a", at, 1), ("a", at - dt.timedelta(days=2), 2), ("b", at - dt.timedelta(days=4), 3), ("c", at + dt.timedelta(hours=1), 4)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v int")
    assert [r["k"] for r in incremental.after_mark(df, "ts", "2024-01-10 00:00:00").collect()] == ["c"]
    out = {r["k"]: r["v"] for r in incremental.with_lookback(df, "ts", "2024-01-10 00:00:00", ["k"], ["ts"]).collect()}
    assert out == {"a": 1, "c": 4}


def test_loaded_files_are_duplicates(spark):
    listing = spark.createDataFrame([("S3", "a.csv"), ("S3", "b.csv"), ("S1", "a.csv")], "source_system string, filename string")
    log = spark.createDataFrame([("S3", "a.csv", "SUCCESS"), ("S3", "b.csv", "FAILED")], "source_system string, filename string, load_status string")
    assert incremental.new_files(listing, log).count() == 2
    got = {(r[0], r[1]): r[2] for r in incremental.mark_duplicates(listing, log).collect()}
    assert got == {("S3", "a.csv"): "DUPLICATE", ("S3", "b.csv"): "PENDING", ("S1", "a.csv"): "PENDING"}


def test_retention_split_is_whole(spark):
    days = ["2024-01-01", "2019-01-01", "2010-01-01", None]
    df = spark.createDataFrame([(d,) for d in days], "t string").select(F.col("t").cast("date").alias("d"))
    as_of = F.lit("2024-06-01").cast("date")
    parts = governance.split_by_retention(df, "d", as_of, "silver")
    assert {k: v.count() for k, v in parts.items()} == {"KEEP": 2, "ARCHIVE": 1, "DELETE": 1}
    classes = df.select(governance.retention_class(F.col("d"), as_of, "silver").alias("c")).groupBy("c").count()
    assert {r["c"]: r["count"] for r in classes.collect()} == {"KEEP": 2, "ARCHIVE": 1, "DELETE": 1}
    assert {k: v.count() for k, v in governance.split_by_retention(df, "d", as_of, "gold").items()} == {
        "KEEP": 2, "ARCHIVE": 2, "DELETE": 0}
    assert {k: v.count() for k, v in governance.split_by_retention(df, "d", as_of, "audit").items()} == {
        "KEEP": 3, "ARCHIVE": 0, "DELETE": 1}


def test_consent_erasure_and_row_security(spark):
    df = spark.createDataFrame([(1, "CHN"), (2, "MDU"), (3, "MDU")], "p int, hospital_code string")
    consents = spark.createDataFrame([(1, True), (2, False)], "p int, consent boolean")
    assert [r["p"] for r in governance.with_consent(df, consents, "p").collect()] == [1]
    kept = governance.erase({"a": df}, spark.createDataFrame([(2,), (2,)], "p int"), "p")
    assert sorted(r["p"] for r in kept["a"].collect()) == [1, 3]
    users = spark.createDataFrame([("u", "MDU"), ("v", "CHN")], "user_name string, hospital_code string")
    assert sorted(r["p"] for r in governance.visible_rows(df, users, "u").collect()) == [2, 3]
    assert governance.visible_rows(df, users, "nobody").count() == 0


def test_failure_streaks(spark):
    status = "SFFSFFFSSF"
    rows = [("p", dt.date(2024, 1, 1) + dt.timedelta(days=i // 3), i, "FAILED" if c == "F" else "SUCCESS") for i, c in enumerate(status)]
    df = spark.createDataFrame(rows, "k string, d date, id int, status string")
    out = audit.failure_streaks(df, "k", ["d", "id"], at_least=1)
    assert sorted(r["failures"] for r in out.collect()) == [1, 2, 3]


def test_audit_record_and_budget(spark):
    start = dt.datetime(2024, 1, 1, 1)
    row = audit.audit_record(spark, pipeline="p", job="j", run_id="r", source="s", entity="e", read=3, written=2, rejected=1,
                             status="SUCCESS", start=start, end=start + dt.timedelta(seconds=90)).first()
    assert (row["duration_seconds"], row["error_message"]) == (90, "")
    log = spark.createDataFrame([("a", 100), ("a", 50), ("b", 4000), ("b", 3600)], "pipeline_name string, duration_seconds long")
    budgets = literal_table(spark, [("a", 60), *audit.JOB_BUDGETS], "pipeline_name string, sla_seconds int")
    assert sorted((r["pipeline_name"], r["duration_seconds"]) for r in audit.over_budget(log, budgets).collect()) == [("a", 100), ("b", 4000)]


def test_threshold_alerts(spark):
    df = spark.createDataFrame([("CHN", 5.0, 9.0), ("MDU", 6.0, None)], "h string, readmission_rate_pct double, denial_rate_pct double")
    got = sorted((r["h"], r["alert_id"]) for r in alerts.threshold_alerts(df, ["h"]).collect())
    assert got == [("CHN", "ALT-012"), ("MDU", "ALT-011")]


def test_payload_drift_sees_inside_lists_and_objects(spark):
    registered = T.StructType.fromDDL("a bigint, b struct<c:string>, d array<bigint>, lost string")
    rows = [("x", '{"a": 1, "b": {"c": "t", "new": true}, "d": [1, 2]}'), ("x", '{"a": "one", "d": []}'), ("x", "no json"), ("x", None),
            ("y", '{"a": 1, "b": {"c": "t"}, "d": [3], "lost": "here"}'), ("y", '{"lost": null, "odd name": 1}'), ("z", "[")]
    df = spark.createDataFrame(rows, "k string, p string")
    got = {(r.member, r.column_name, r.message) for r in quality.payload_drift(df, "p", registered, "k").collect()}
    assert got == {("x", "a", "type bigint became variant"), ("x", "b.new", "added as boolean"), ("x", "lost", "removed"),
                   ("x", None, "1 payloads are no JSON"), ("y", "odd name", "added as bigint"), ("z", None, "1 payloads are no JSON")}
    assert quality.payload_drift(df.limit(0), "p", registered, "k").count() == 0


def test_merged_sketches_keep_the_rank(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), F.when(F.col("id") % 3 == 0, 7).otherwise(
        F.xxhash64("id") % 100_000).alias("v"))
    daily = aggregates.percentile_sketches(df, ["day"], "v")
    assert daily.count() == 30
    for p in (0.01, 0.5, 0.95):
        got = aggregates.sketched_percentile(daily, [(F.col("day") % 2).alias("half")], p, "q").collect()
        for r in got:
            rows = df.where(F.col("day") % 2 == r["half"])
            n, below, upto = rows.agg(F.count("v"), F.count_if(F.col("v") < r["q"]), F.count_if(F.col("v") <= r["q"])).first()
            assert r["n"] == n and below / n - aggregates.SKETCH_RANK_ERROR <= p <= upto / n + aggregates.SKETCH_RANK_ERROR


def test_an_audited_write_computes_its_rows_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("boolean", useArrow=False)
    def good(i):
        made.add(1)
        return None if i % 10 == 0 else i % 3 > 0

    at = dt.datetime(2024, 1, 1)
    df = spark.range(0, 100, 1, 4).withColumn("ok", good("id"))
    row = audit.audited_write(df, str(tmp_path / "t"), "ok", pipeline="p", job="j", run_id="r", source="s", entity="e", start=at,
                              clock=lambda: at).first()
    want = sum(1 for i in range(100) if i % 10 and i % 3)
    assert (row["records_read"], row["records_written"], row["records_rejected"]) == (100, want, 100 - want) and made.value == 100
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.where("_valid = 'true'").count() == want and stored.where("_valid = 'false'").count() == 100 - want


def plain_luhn(number):
    total = 0
    for i, x in enumerate(reversed(number)):
        d = int(x) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_verhoeff(number):
    """Products of symmetries of a pentagon, as permutations of its corners."""
    def corner(e):
        return tuple((c + e) % 5 for c in range(5)) if e < 5 else tuple((e - 5 - c) % 5 for c in range(5))

    elements = [corner(e) for e in range(10)]
    step, product = [1, 5, 7, 6, 2, 8, 3, 0, 9, 4], elements[0]
    for place, x in enumerate(reversed(number)):
        d = int(x)
        for _ in range(place % 8):
            d = step[d]
        product = tuple(product[elements[d][c]] for c in range(5))
    return product == elements[0]


def test_check_digits(spark):
    from carelake.functions.checkdigits import luhn_valid, verhoeff_valid

    numbers = spark.range(5000).select((F.col("id") * 7_777_777 + 100_000_000_000).cast("string").alias("n"))
    for r in numbers.select("n", verhoeff_valid(F.col("n")).alias("v"), luhn_valid(F.col("n")).alias("l")).collect():
        assert r["v"] == plain_verhoeff(r["n"]) and r["l"] == plain_luhn(r["n"]), r["n"]
    odd = spark.createDataFrame([("2363",), ("236-3",), ("",), (None,), ("23a63",), (" - ",)], "n string")
    assert [r[0] for r in odd.select(verhoeff_valid(F.col("n"))).collect()] == [True, True, False, False, False, False]


def test_only_numbers_with_their_check_digit_count(spark):
    right = next(d for d in range(10) if plain_verhoeff(f"23634567890{d}"))
    texts = ["pay 4539 1488 0343 6467 now", "order 4539148803436468", f"id 2363 4567 890{right}", f"id 23634567890{(right + 1) % 10}",
             f"23634567890{(right + 1) % 10} and 23634567890{right}", "no number", None]
    got = {r["pattern"]: (r["hits"], r["valid_hits"]) for r in quality.checked_scan(
        spark.createDataFrame([(t,) for t in texts], "t string"), "x", ["t"]).collect()}
    assert got["card"] == (2, 1)
    groups = re.findall(quality.CHECKED_PATTERNS["identifier_12"][0], texts[0])
    assert got["identifier_12"] == (3 + bool(groups), 2 + any(plain_verhoeff(re.sub("[ -]", "", g)) for g in groups))
