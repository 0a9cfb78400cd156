"""Streams over file sources, compared with the batch form of the same transformation."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from carelake.sources import schemas
from carelake.streaming import inventory, parse, runtime, windows

AT = dt.datetime(2024, 1, 15, 8, 0)


def log_rows(spark, values, start=0, topic="t", at=AT):
    rows = [(b"k", json.dumps(v).encode() if not isinstance(v, bytes) else v, topic, 0, start + i, at + dt.timedelta(seconds=i))
            for i, v in enumerate(values)]
    return spark.createDataFrame([tuple(map(lambda x: bytearray(x) if isinstance(x, bytes) else x, r)) for r in rows], schemas.KAFKA_ROW)


def land(spark, folder, values, start=0, at=AT):
    log_rows(spark, values, start, at=at).coalesce(1).write.mode("append").parquet(str(folder))


def source(spark, folder, cap=1):
    return spark.readStream.schema(schemas.KAFKA_ROW).option("maxFilesPerTrigger", cap).parquet(str(folder))


def reading(i, **changes):
    base = {"device_id": f"ICU-{i}", "patient_mrn": f"M{i}", "hospital_code": "CHN", "heart_rate": 80, "spo2": 97.0,
            "systolic_bp": 120, "temperature_c": 37.0, "recorded_at": (AT + dt.timedelta(seconds=i)).isoformat()}
    return base | changes


VITALS = [reading(0), reading(1, heart_rate=40), reading(2, heart_rate=None), reading(3, spo2=50.0), reading(4, spo2=92.0),
          reading(5, patient_mrn=None), reading(6, systolic_bp=190), b"not json"]


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_vitals_stream_equals_the_batch(spark, tmp_path):
    src, root = tmp_path / "src", str(tmp_path / "out")
    land(spark, src, VITALS[:4])
    land(spark, src, VITALS[4:], start=4)
    spec = runtime.vitals_spec(root, "run")

    def go():
        run(runtime.start(parse.vitals(source(spark, src), "run"), runtime.route_batch(spec), str(tmp_path / "cp"), "v", mode="batch"))

    go()
    batch = parse.vitals(log_rows(spark, VITALS), "run").select("offset", "alert_level", "dq_passed").collect()
    valid = spark.read.parquet(spec.folder("bronze"))
    dead = spark.read.parquet(spec.folder("dlq"))
    assert {r["offset"]: r["alert_level"] for r in valid.collect()} == {r["offset"]: r["alert_level"] for r in batch if r["dq_passed"]}
    assert sorted(r["offset"] for r in dead.collect()) == sorted(r["offset"] for r in batch if not r["dq_passed"]) == [2, 3, 5, 7]
    assert dead.first()["rejection_reason"].startswith("DQ validation failed")
    audit = spark.read.parquet(spec.folder("audit"))
    assert audit.agg(F.sum("records_read"), F.sum("records_written"), F.sum("records_rejected")).first()[:] == (8, 4, 4)
    assert sorted(r["run_id"] for r in audit.collect()) == ["run-batch0", "run-batch1"]
    alert = {r["batch_id"]: (r["alert_rows"], r["message"]) for r in spark.read.parquet(spec.folder("alerts")).collect()}
    assert alert[0][0] == 1 and alert[0][1].startswith("ICU-1: pulse=40")
    assert alert[1][1].startswith("ICU-6")

    go()  # restart: nothing new, nothing twice
    assert spark.read.parquet(spec.folder("bronze")).count() == 4
    land(spark, src, [reading(9)], start=20)
    go()
    assert spark.read.parquet(spec.folder("bronze")).count() == 5


def test_a_new_checkpoint_keeps_the_batches_of_the_old_one(spark, tmp_path):
    src, spec = str(tmp_path / "src"), runtime.vitals_spec(str(tmp_path), "run")
    land(spark, src, [reading(1), reading(2)])
    stream = lambda: parse.vitals(spark.readStream.schema(spark.read.parquet(src).schema).parquet(src), "run")
    for name in ("a", "b"):
        runtime.start(stream(), runtime.route_batch(spec), str(tmp_path / f"ck-{name}"), name, mode="batch").awaitTermination()
    landed = spark.read.parquet(spec.folder("bronze"))
    assert landed.select("query_id").distinct().count() == 2 and landed.groupBy("query_id").count().distinct().count() == 2


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    spec = runtime.vitals_spec(str(tmp_path), "run")
    rows = parse.vitals(log_rows(spark, VITALS), "run")
    process = runtime.route_batch(spec)
    for _ in range(2):
        process(rows, 3)
    assert spark.read.parquet(spec.folder("bronze")).count() == 4
    assert spark.read.parquet(spec.folder("audit")).count() == 1


def claim(i, **changes):
    base = {"claim_id": f"C{i}", "patient_mrn": "M", "hospital_code": "CHN", "insurer_code": "P", "claim_amount": 1000.0,
            "approved_amount": 500.0, "status": "APPROVED", "service_date": "2024-01-10", "submitted_at": "2024-01-15T08:00:00Z",
            "icd_codes": ["J06.9", "I10"], "procedure_codes": ["99213"], "is_inpatient": False}
    return base | changes


CLAIMS = [claim(0), claim(1, status="DENIED", claim_amount=120000.0), claim(2, status="LOST"), claim(3, claim_amount=0.0),
          claim(4, claim_amount=None), claim(5, hospital_code="XX"), claim(6, icd_codes=None), claim(7, claim_id=None)]


def test_claims_stream(spark, tmp_path):
    src, root = tmp_path / "src", str(tmp_path / "out")
    land(spark, src, CLAIMS)
    spec = runtime.claims_spec(root, "run")
    run(runtime.start(parse.claims(source(spark, src), "run"), runtime.route_batch(spec), str(tmp_path / "cp"), "c", mode="batch"))
    rows = {r["claim_id"]: r for r in spark.read.parquet(spec.folder("bronze")).collect()}
    assert set(rows) == {"C0", "C1", "C6"}
    c0, c1, c6 = rows["C0"], rows["C1"], rows["C6"]
    assert (c0["icd_codes_str"], c0["icd_count"], c0["approval_ratio"], c0["is_high_value"]) == ("J06.9|I10", 2, 0.5, False)
    assert (c1["is_high_value"], c1["fraud_risk_flag"]) == (True, True)
    assert (c6["icd_codes_str"], c6["icd_count"]) == (None, None)
    assert "icd_codes" not in c0.asDict() and "dq_passed" not in c0.asDict()
    assert c0["service_date_ts"] == dt.date(2024, 1, 10)
    assert spark.read.parquet(spec.folder("dlq")).count() == 5
    assert spark.read.parquet(spec.folder("alerts")).first()["message"] == "C1 DENIED 120000.0"


def change(op, key, qty=None, wrapped=True, table="drug_inventory", ts=1, bare_names=False, **extra):
    names = ("item_id", "stock_count") if bare_names else ("inventory_id", "quantity_units")
    row = {names[0]: key, names[1]: qty, "drug_name": f"drug {key}", "hospital_code": "CHN", "is_critical": qty is not None and qty < 5} | extra
    body = {"op": op, "source": {"table": table, "ts_ms": ts}, "ts_ms": ts,
            "before": json.dumps(row) if op == "d" else None, "after": None if op == "d" else (json.dumps(row) if wrapped else row)}
    return {"payload": body} if wrapped else body


def state(spark, root):
    return {r["inventory_id"]: (r["quantity_units"], r["_is_deleted"]) for r in inventory.current_inventory(spark, root).collect()}


def test_inventory_stream(spark, tmp_path):
    src, root = tmp_path / "src", str(tmp_path / "out")
    first = [change("c", "a", 1), change("u", "a", 2, ts=2), change("c", "b", 7), change("d", "zz"),
             change("c", "x", 1, table="dispensing_log", dispense_id="D1"), change("u", "x", 1, table="dispensing_log", dispense_id="D1")]
    second = [change("d", "a", ts=3), change("u", "e", 3, wrapped=False, bare_names=True, ts=3), change("u", "b", 6, ts=0)]

    def go():
        run(runtime.start(source(spark, src), inventory.land_batch(root), str(tmp_path / "cp"), "i", mode="batch"))

    assert state(spark, root) == {}
    land(spark, src, first)
    go()
    assert state(spark, root) == {"a": (2, False), "b": (7, False)}
    assert [r["dispense_id"] for r in spark.read.parquet(f"{root}/dispensing").collect()] == ["D1"]
    inventory.compact(spark, root)
    assert state(spark, root) == {"a": (2, False), "b": (7, False)}
    land(spark, src, second, start=50)
    go()
    want = {"a": (2, True), "b": (6, False), "e": (3, False)}
    assert state(spark, root) == want
    inventory.compact(spark, root)
    inventory.compact(spark, root)
    assert state(spark, root) == want
    assert [r["inventory_id"] for r in inventory.critical_stock(inventory.current_inventory(spark, root)).collect()] == ["e"]


def memory(stream, name, mode="append"):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    run(query)
    return query


def test_replayed_events_are_dropped(spark, tmp_path):
    src = tmp_path / "src"
    land(spark, src, VITALS[:2])
    land(spark, src, VITALS[:2])
    events = windows.drop_replays(parse.vitals(source(spark, src), "run"))
    memory(events.select("offset"), "replays")
    assert sorted(r[0] for r in spark.table("replays").collect()) == [0, 1]


def test_late_events_do_not_reopen_a_window(spark, tmp_path):
    src = tmp_path / "src"

    def at(minute):
        return (AT + dt.timedelta(minutes=minute)).isoformat()

    land(spark, src, [reading(0, recorded_at=at(1)), reading(1, recorded_at=at(2))])
    # A batch drops rows behind the watermark its predecessor started with.
    land(spark, src, [reading(2, recorded_at=at(30))], start=10)
    land(spark, src, [reading(2, recorded_at=at(31))], start=15)
    land(spark, src, [reading(3, recorded_at=at(3)), reading(4, recorded_at=at(50))], start=20)
    land(spark, src, [reading(5, recorded_at=at(90))], start=30)
    memory(windows.window_summary(parse.vitals(source(spark, src), "run"), "5 minutes"), "closed")
    got = {r["window_start"]: r["readings"] for r in spark.table("closed").collect()}
    assert got[AT] == 2
    assert sum(got.values()) == 5


def test_window_stream_equals_the_batch_without_late_events(spark, tmp_path):
    src = tmp_path / "src"
    values = [reading(i, recorded_at=(AT + dt.timedelta(minutes=i)).isoformat(), heart_rate=60 + i) for i in range(40)]
    land(spark, src, values[:20])
    land(spark, src, values[20:], start=20)
    memory(windows.window_summary(parse.vitals(source(spark, src), "run"), "15 minutes"), "w15", "complete")
    want = windows.window_summary(parse.vitals(log_rows(spark, values), "run"), "15 minutes")
    assert sorted(spark.table("w15").collect()) == sorted(want.collect())


def test_trigger_modes(spark, tmp_path):
    (tmp_path / "src").mkdir()
    query = runtime.start(source(spark, tmp_path / "src"), lambda df, i: None, str(tmp_path / "cp"), "t", "continuous", "1 minute")
    assert query.isActive
    query.stop()
    with pytest.raises(ValueError):
        runtime.start(source(spark, tmp_path / "src"), lambda df, i: None, str(tmp_path / "cp2"), "t", "sometimes")


def test_lag_status(spark):
    offsets = spark.createDataFrame([("a", 0, 100, 90), ("a", 1, 50, None), ("b", 0, 10, 10)],
                                    "topic string, partition int, end_offset long, committed_offset long")
    limits = spark.createDataFrame([("a", 59), ("b", 100)], "topic string, lag_limit int")
    got = {r["topic"]: (r["total_lag"], r["status"]) for r in windows.consumer_lag(offsets, limits).collect()}
    assert got == {"a": (60, "BREACH"), "b": (0, "OK")}


def test_late_classification(spark):
    rows = [(i, AT + dt.timedelta(minutes=m), "s") for i, m in enumerate([0, 10, 5, 4, 20, 14])]
    df = spark.createDataFrame(rows, "id int, ts timestamp, s string").withColumn("arrived", F.lit(AT) + F.make_dt_interval(mins=F.col("id")))
    out = windows.classify_late(df, "ts", ["arrived", "id"], 5, ["s"])
    assert [r["lateness"] for r in out.orderBy("id").collect()] == ["ON_TIME", "ON_TIME", "ON_TIME", "LATE", "ON_TIME", "LATE"]
