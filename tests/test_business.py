import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carelake.operators import fraud, kpi, lab, pharmacy, quality
from carelake.plans import layers
from carelake.sources import sinks

D = dt.date
ADMISSION = "admission_id int, patient_id int, hospital_code string, admission_date date, discharge_date date"


@pytest.fixture
def admissions(spark):
    return spark.createDataFrame([
        (1, 1, "CHN", D(2024, 1, 1), D(2024, 1, 5)),
        (2, 1, "MDU", D(2024, 2, 4), D(2024, 2, 6)),   # 30 days after the discharge
        (3, 1, "CHN", D(2024, 3, 9), None),            # 32 days
        (4, 1, "CHN", D(2024, 3, 10), None),           # previous stay still open
        (5, 2, "CHN", D(2024, 1, 1), D(2024, 1, 1)),
        (6, 2, "CHN", D(2024, 1, 1), D(2024, 1, 3)),   # same day
    ], ADMISSION)


def test_readmissions(admissions):
    got = {r["admission_id"]: (r["days_since_discharge"], r["is_readmission"]) for r in kpi.readmissions(admissions).collect()}
    assert got == {1: (None, 0), 2: (30, 1), 3: (32, 0), 4: (None, 0), 5: (None, 0), 6: (0, 1)}


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_summary_without_claims_and_vitals(spark, admissions):
    claims = empty(spark, "claim_id string, hospital_code string, claim_date date, status string, approved_amount decimal(12,2)")
    vitals = empty(spark, "hospital_code string, event_ts timestamp, heart_rate int, spo2 double, alert_level string")
    rows = {(r["hospital_code"], r["kpi_date"]): r for r in kpi.daily_summary(admissions, claims, vitals).collect()}
    r = rows["CHN", D(2024, 1, 1)]
    assert (r["new_admissions"], r["discharges"], r["readmission_count"], r["readmission_rate_pct"]) == (3, 3, 1, 33.33)
    assert (r["claims_submitted"], r["revenue_inr"], r["denial_rate_pct"], r["avg_heart_rate"]) == (0, Decimal("0.00"), None, None)
    assert r["avg_los_days"] == 2.0
    assert rows["CHN", D(2024, 3, 9)]["avg_los_days"] is None


CLAIM = ("claim_id string, patient_id int, physician_id int, procedure_code string, diagnosis_code string, claim_date date, "
         "claim_amount double, submission_ts timestamp, status string, hospital_code string, approved_amount decimal(12,2)")


def a_claim(i, **c):
    base = dict(claim_id=f"c{i}", patient_id=i, physician_id=i, procedure_code="P", diagnosis_code="D", claim_date=D(2024, 1, 10),
                claim_amount=10.0, submission_ts=dt.datetime(2024, 1, 10, 12), status="APPROVED", hospital_code="CHN", approved_amount=None)
    return tuple((base | c).values())


def test_fraud_rules(spark):
    rows = [a_claim(i, patient_id=500, claim_date=D(2024, 1, 1 + 3 * i), procedure_code="R") for i in range(4)]  # days 1 4 7 10
    rows += [a_claim(10, claim_amount=250000.0), a_claim(11, claim_amount=200000.0)]
    rows += [a_claim(20, patient_id=600)]
    rows += [a_claim(30 + i, physician_id=700) for i in range(31)]
    rows += [a_claim(80, diagnosis_code="J06.9", procedure_code="27447", claim_amount=200001.0)]
    discharges = spark.createDataFrame([(600, dt.datetime(2024, 1, 10, 11, 0, 1)), (600, dt.datetime(2024, 1, 10, 11, 30)), (10, dt.datetime(2024, 1, 10, 11))],
                                       "patient_id int, discharge_ts timestamp")
    scored = fraud.flag_rules(spark.createDataFrame(rows, CLAIM), discharges)
    got = {r["claim_id"]: (r["f1"], r["f2"], r["f3"], r["f4"], r["f5"], r["fraud_score"]) for r in scored.collect()}
    assert len(got) == len(rows)
    assert [got[f"c{i}"][0] for i in range(4)] == [0, 0, 1, 1]
    assert got["c10"] == (0, 1, 0, 0, 0, 2) and got["c11"][1] == 0
    assert got["c20"] == (0, 0, 1, 0, 0, 2)
    assert all(got[f"c{30 + i}"][3] == 1 for i in range(31))
    assert got["c80"] == (0, 1, 0, 0, 1, 5)
    flagged = fraud.flags(scored).collect()
    assert [r["claim_id"] for r in flagged] == ["c80"]


def test_discharges_are_looked_up_where_they_decide(spark, monkeypatch):
    at = dt.datetime(2024, 1, 10, 11, 30)
    rows = [a_claim(1, claim_amount=250000.0)]                                                     # 2, and 4 with a discharge
    rows += [a_claim(10 + i, patient_id=500, procedure_code="R", physician_id=None) for i in range(3)]  # 3, and 5
    rows += [a_claim(20 + i, patient_id=600, procedure_code="R", claim_amount=250000.0) for i in range(3)]  # 5
    rows += [a_claim(30, diagnosis_code=None, claim_amount=None), a_claim(31, patient_id=None)]
    claims = spark.createDataFrame(rows, CLAIM)
    discharges = spark.createDataFrame([(1, at), (500, at)], "patient_id int, discharge_ts timestamp")
    asked = []
    look_up = fraud.recent_event_flag
    monkeypatch.setattr(fraud, "recent_event_flag", lambda df, *rest: asked.append(df.count()) or look_up(df, *rest))
    every = fraud.flag_rules(claims, discharges)
    found = fraud.flag_rules(claims, discharges, at_least=fraud.FLAG_SCORE)
    assert asked == [len(rows), 6]
    assert sorted(every.filter("fraud_score >= 5").collect(), key=str) == sorted(found.collect(), key=str) and found.count() == 6


@pytest.mark.parametrize("amount, points", [(250000, 2), (50000, 0), (200000, 0), (None, 0)])
def test_amount_points(spark, amount, points):
    df = spark.createDataFrame([(amount,)], "a int")
    assert df.select(fraud.amount_points(F.col("a"))).first()[0] == points


def test_gold_plan(spark, admissions):
    claims = spark.createDataFrame([a_claim(1)], CLAIM)
    vitals = empty(spark, "hospital_code string, event_ts timestamp, heart_rate int, spo2 double, alert_level string")
    discharges = empty(spark, "patient_id int, discharge_ts timestamp")
    out = layers.gold(admissions, claims, vitals, discharges)
    written = layers.published(out["kpi_daily_summary"], "run", F.lit("2024-01-11 02:00:00"))
    assert written.count() == 4 and {"pipeline_run_id", "refreshed_at"} <= set(written.columns)
    assert out["fraud_flags"].count() == 0


def test_stock_cover_and_transfers(spark):
    stock = spark.createDataFrame([("d", "CHN", 10), ("d", "MDU", 500), ("d", "CBE", 140), ("e", "CHN", 1)], "drug string, site string, current_stock int")
    use = spark.createDataFrame([("d", "CHN", 10.0), ("d", "MDU", 10.0), ("d", "CBE", 10.0), ("e", "CHN", 0.0)], "drug string, site string, avg_daily_consumption double")
    cover = pharmacy.stock_cover(stock, use, ["drug", "site"])
    assert {(r["drug"], r["site"]): r["days_of_stock_remaining"] for r in cover.collect()} == {
        ("d", "CHN"): 1.0, ("d", "MDU"): 50.0, ("d", "CBE"): 14.0, ("e", "CHN"): None}
    assert [(r["drug"], r["site"]) for r in pharmacy.stockout_alerts(stock, use, ["drug", "site"]).collect()] == [("d", "CHN")]
    out = pharmacy.transfer_suggestions(cover, "drug", "site").collect()
    assert [(r["from_site"], r["to_site"], r["transfer_units"]) for r in out] == [("MDU", "CHN", 60)]


def test_lab_summary_and_critical(spark):
    at = dt.datetime(2024, 1, 1, 7)
    labs = spark.createDataFrame([("STAT", "POTASSIUM", 6.6, at, 3601), ("STAT", "GLUCOSE", 39.0, at, 3600), ("ROUTINE", "GLUCOSE", 40.0, at, 14401)],
                                 "order_type string, test string, value double, collected timestamp, tat_seconds long").withColumn("h", F.lit("CHN"))
    out = {r["order_type"]: r for r in lab.turnaround_summary(labs, ["h"]).collect()}
    assert (out["STAT"]["total_tests"], out["STAT"]["sla_breaches"], out["ROUTINE"]["sla_breaches"]) == (2, 1, 1)
    assert out["STAT"]["p95_tat_hours"] == pytest.approx((3600 + 0.95) / 3600, abs=1e-4)
    assert sorted(r["test"] for r in lab.critical_results(labs, "test", "value").collect()) == ["GLUCOSE", "POTASSIUM"]
    shifts = lab.breaches_by_shift(labs, "h", "collected").collect()
    assert [(r["shift"], r["sla_breaches"]) for r in shifts] == [("MORNING", 2)]


def test_flagged_within_fifteen_minutes(spark):
    at = dt.datetime(2024, 1, 1, 7)
    df = spark.createDataFrame([("x", at, at + dt.timedelta(minutes=m)) for m in (0, 15, 16)], "k string, released timestamp, flagged timestamp")
    r = lab.flagged_in_time(df, "released", "flagged", ["k"]).first()
    assert (r["critical_results"], r["flagged_in_time"], r["in_time_pct"]) == (3, 2, 66.67)


def test_at_risk_claims(spark):
    df = spark.createDataFrame([("a", "PENDING", D(2024, 1, 1)), ("b", "PENDING", D(2024, 1, 2)), ("c", "PAID", D(2023, 1, 1)), ("d", "IN_REVIEW", D(2023, 1, 1))],
                               "claim_id string, status string, claim_date date")
    out = kpi.claims_at_risk(df, F.lit("2024-02-01").cast("date")).collect()
    assert sorted(r["claim_id"] for r in out) == ["a", "d"]


def test_wastage(spark):
    df = spark.createDataFrame([(D(2024, 1, 10), 10.0), (D(2024, 3, 1), 990.0), (D(2024, 4, 1), 5.0)], "expiry_date date, stock_value double")
    out = {r["quarter"]: (r["wastage_pct"], r["breach"]) for r in pharmacy.wastage_by_quarter(df, F.lit("2024-01-31").cast("date")).collect()}
    assert out == {D(2024, 1, 1): (1.0, False), D(2024, 4, 1): (0.0, False)}


def test_full_summary(spark):
    day = D(2024, 1, 1)
    summary = spark.createDataFrame([("CHN", day, 3), ("MDU", day, 1)], "hospital_code string, kpi_date date, new_admissions int")
    adm = spark.createDataFrame([(1, "CHN", day), (1, "CHN", day), (2, "CHN", day), (3, "MDU", day)], "patient_id int, hospital_code string, admission_date date")
    vitals = spark.createDataFrame([("CHN", i % 10, dt.datetime(2024, 1, 1, i)) for i in range(12)] + [("CHN", 10, dt.datetime(2024, 1, 2))],
                                   "hospital_code string, device_id int, event_ts timestamp")
    beds = vitals.groupBy("hospital_code").agg(F.countDistinct("device_id").alias("icu_beds_total"))
    icu = kpi.icu_utilisation(vitals, beds)
    flagged = spark.createDataFrame([("CHN", day), ("CHN", day)], "hospital_code string, flag_date date")
    rows = {r["hospital_code"]: r for r in kpi.full_summary(summary, adm, icu, flagged).collect()}
    c, m = rows["CHN"], rows["MDU"]
    assert (c["total_patients"], c["icu_beds_occupied"], c["icu_beds_total"], c["icu_utilization_pct"], c["fraud_flags_count"]) == (2, 10, 11, 90.91, 2)
    assert (m["total_patients"], m["icu_beds_occupied"], m["fraud_flags_count"]) == (1, None, 0)
    assert {(r["kpi_date"].day, r["breach"]) for r in icu.collect()} == {(1, True), (2, False)}


def test_silver_rules(spark):
    df = spark.createDataFrame([(" ab ", None, dt.datetime(2024, 1, 1, 5, 30), "Keep", None)], "a string, b string, t timestamp, k string, n int")
    r = layers.standardised(df, "Asia/Kolkata", keep_case=["k"]).first()
    assert tuple(r) == ("AB", "UNKNOWN", dt.datetime(2024, 1, 1), "Keep", -1)


@pytest.mark.parametrize("seed", range(3))
def test_every_unit_is_promised_once(spark, seed):
    """Random drugs: no giver sends more than it can spare; every shortage is filled, or every surplus used."""
    r = random.Random(seed)
    rows = [(d, f"S{s:02d}", r.randrange(0, 120), round(r.uniform(0.1, 12), 3)) for d in range(25) for s in range(r.randrange(1, 30))]
    stock = spark.createDataFrame(rows, "drug int, site string, current_stock long, avg_daily_consumption double")
    cover = pharmacy.stock_cover(stock.drop("avg_daily_consumption"), stock.drop("current_stock"), ["drug", "site"])
    sent, got, pairs = {}, {}, set()
    for x in pharmacy.transfer_plan(cover, "drug", "site").collect():
        assert x["transfer_units"] > 0 and (x["drug"], x["from_site"], x["to_site"]) not in pairs
        pairs.add((x["drug"], x["from_site"], x["to_site"]))
        sent[x["drug"], x["from_site"]] = sent.get((x["drug"], x["from_site"]), 0) + x["transfer_units"]
        got[x["drug"], x["to_site"]] = got.get((x["drug"], x["to_site"]), 0) + x["transfer_units"]
    spare = {(d, s): math.floor(n - use * 14) for d, s, n, use in rows if math.floor(n - use * 14) > 0}
    short = {(d, s): math.ceil(use * 7 - n) for d, s, n, use in rows if n < use * 7}
    assert all(units <= spare[k] for k, units in sent.items()) and all(units <= short[k] for k, units in got.items())
    for d in range(25):
        total = sum(u for k, u in spare.items() if k[0] == d), sum(u for k, u in short.items() if k[0] == d)
        assert sum(u for k, u in sent.items() if k[0] == d) == min(total)
    assert len(pairs) <= len(spare) + len(short)


def test_beds_at_a_time(spark):
    at = lambda day, hour, minute=0: dt.datetime(2024, 1, day, hour, minute)
    stays = [("A", at(1, 6), at(1, 18)), ("A", at(1, 18), at(3, 6)), ("A", at(1, 12), None),
             ("A", at(2, 0), at(2, 0)), ("A", at(2, 9), at(2, 8)), ("A", None, at(2, 9)),  # no stay at all
             ("A", at(2, 0), at(3, 0)), ("B", at(2, 23, 59), at(5, 0, 1)), (None, at(3, 0), at(3, 1))]
    df = spark.createDataFrame(stays, "unit string, since timestamp_ntz, until timestamp_ntz")
    got = {(r["unit"], r["day"].day): (r["peak"], r["mean"], r["admissions"]) for r in kpi.beds_at_a_time(
        df, "unit", "since", "until", "2024-01-04").collect() if r["unit"]}
    assert got == {("A", 1): (2, round((12 + 6 + 12) / 24, 6), 3), ("A", 2): (3, 3.0, 1), ("A", 3): (2, 1.25, 0), ("A", 4): (1, 1.0, 0),
                   ("B", 2): (1, round(1 / 1440, 6), 1), ("B", 3): (1, 1.0, 0), ("B", 4): (1, 1.0, 0)}


@pytest.fixture
def silver(tables):
    from carelake.streaming.parse import grade_vitals

    return {"admissions": tables.admissions, "claims": tables.claims(patient=True, diagnosis=True), "vitals": grade_vitals(tables.vitals),
            "discharges": tables.discharges, "labs": tables.labs, "stock": tables.site_stock}


def test_gold_run_publishes_all_tables_with_their_audit(spark, silver, tmp_path):
    root, clock = str(tmp_path / "gold"), lambda: dt.datetime(2024, 1, 31, 2)
    for run in ("a", "b"):
        layers.run_gold(root, silver, run, clock, 2557)
    log = spark.read.parquet(f"{root}/audit").where("run_id = 'b'").collect()
    assert {r["entity_name"] for r in log} == set(layers.REQUIRED) and {r["status"] for r in log} == {"SUCCESS"}
    for r in log:
        table = sinks.read_current(spark, f"{root}/{r['entity_name']}")
        assert r["records_written"] == table.count() and set(layers.REQUIRED[r["entity_name"]]) <= set(table.columns)
        assert table.where("pipeline_run_id <> 'b'").count() == 0
    assert sum(r["records_written"] > 0 for r in log) >= 3  # hardly any claim of the smallest data is flagged


def test_the_gate_stops_a_gold_run_before_anything_is_published(spark, silver, tmp_path):
    root, clock = str(tmp_path / "gold"), lambda: dt.datetime(2024, 1, 31, 2)
    broken = silver | {"admissions": silver["admissions"].withColumn("patient_id", F.when(F.col("admission_id") % 2 == 0, F.col("patient_id")))}
    with pytest.raises(quality.GateHalted, match="admissions.patient_id is NULL in"):
        layers.run_gold(root, broken, "run", clock)
    log = spark.read.parquet(f"{root}/audit").collect()
    assert [(r["entity_name"], r["status"], r["records_written"]) for r in log] == [("gate", "FAILED", 0)] and "patient_id" in log[0]["error_message"]
    assert sinks.current_version(spark, f"{root}/kpi_daily_summary") is None


def test_columns_of_persons_stop_a_gold_run(spark, silver, tmp_path):
    made = layers.gold(silver["admissions"], silver["claims"], silver["vitals"], silver["discharges"])
    found = layers.gold_findings({"fraud_flags": made["fraud_flags"].withColumn("phone_number", F.lit("x")).drop("flag_date")}, str(tmp_path)).collect()
    assert [r["severity"] for r in found] == ["CRITICAL", "CRITICAL"]
