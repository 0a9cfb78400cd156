import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carelake.operators import scd
from carelake.plans import layers
from carelake.sources import kafka, mappings, readers, schemas, sinks

PATIENTS = """patient_id,first_name,last_name,date_of_birth,gender,phone_number,aadhaar_number,address_line1,city,pincode,insurance_plan_id,blood_group,admission_count,created_at,updated_at
70, Odalys ,Brandt,03-11-1990,F,9000054321,700011112222,9 Quay,Chennai,601234,PLAN-A,O-,6,2022-05-04 07:00:00,2024-02-20 06:05:00
71,Teo,Marchetti,12-30-1961,M,9000065432,700011113333,4 Mill Lane,Salem,602345,PLAN-B,,2,2022-06-07 08:00:00,2024-02-20 07:45:00
72,Nil,Broken,??,Q,55,,1 Gate,Erode,77,PLAN-B,AB+,many,2022-06-07 08:00:00,2024-02-18 07:45:00
"""


def write(path, body, encoding="utf-8"):
    path.write_text(body, encoding=encoding)
    return str(path)


def test_patients(spark, tmp_path):
    rows = {r["patient_id_src"]: r for r in readers.read_patients(spark, write(tmp_path / "p.csv", PATIENTS)).collect()}
    a, b, c = rows["HIS-CHN-70"], rows["HIS-CHN-71"], rows["HIS-CHN-72"]
    assert (a["first_name"], a["date_of_birth"], a["gender"], a["admission_count"]) == ("ODALYS", dt.date(1990, 11, 3), "Female", 6)
    assert b["date_of_birth"] == dt.date(1961, 12, 30) and b["blood_group"] is None
    assert (c["date_of_birth"], c["gender"], c["admission_count"], c["aadhaar_hash"]) == (None, None, None, None)
    assert a["updated_at"] == dt.datetime(2024, 2, 20, 6, 5)
    assert len(a["aadhaar_hash"]) == 64 and "aadhaar_number" not in a.asDict()


def test_labs_with_bom_in_one_scan(spark, tmp_path):
    head = "OrderID,PatientMRN,TestCode,SpecimenCollected,ResultReleased\n"
    write(tmp_path / "a.csv", head + "L1,M1, cbc ,2024-01-15 08:00,2024-01-15 10:00\n", "utf-8-sig")
    write(tmp_path / "b.csv", head + "L2,M2,K,15-01-2024 08:00,01-25-2024 10:00\n")
    write(tmp_path / "notes.txt", "not a lab file")
    rows = {r["order_id"]: r for r in readers.read_labs(spark, str(tmp_path)).collect()}
    assert set(rows) == {"L1", "L2"}
    assert (rows["L1"]["test_code"], rows["L1"]["_src_filename"], rows["L1"]["order_type"]) == ("CBC", "a.csv", None)
    assert rows["L2"]["specimen_collected_ts"] == dt.datetime(2024, 1, 15, 8)
    assert rows["L2"]["result_released_ts"] == dt.datetime(2024, 1, 25, 10)


def test_files_of_a_folder_keep_their_own_headers(spark, tmp_path):
    write(tmp_path / "a.csv", "OrderID,PatientMRN,TestCode,SpecimenCollected,ResultReleased\nL1,M1,CBC,2024-01-15 08:00,2024-01-15 10:00\n")
    write(tmp_path / "b.csv", "TestCode,ResultReleased,OrderID,Extra,SpecimenCollected,PatientMRN\nK,2024-01-16 10:00,L2,e,2024-01-16 08:00,M2\n", "utf-8-sig")
    write(tmp_path / "c.csv", "")
    got = {r["order_id"]: r for r in readers.read_labs(spark, str(tmp_path)).collect()}
    assert {k: (r["patient_mrn_src"], r["test_code"], r["_src_filename"]) for k, r in got.items()} == {
        "L1": ("M1", "CBC", "a.csv"), "L2": ("M2", "K", "b.csv")}
    assert got["L2"]["specimen_collected_ts"] == dt.datetime(2024, 1, 16, 8)
    raw = {r["OrderID"]: r["Extra"] for r in readers.read_csv(spark, str(tmp_path), pattern="*.csv").collect()}
    assert raw == {"L1": None, "L2": "e"}
    write(tmp_path / "d.csv", "OrderID,PatientMRN\nL3,M3\n")
    with pytest.raises(ValueError, match="TestCode"):
        readers.read_labs(spark, str(tmp_path))


def test_lab_file_without_required_column(spark, tmp_path):
    write(tmp_path / "a.csv", "OrderID,PatientMRN\nL1,M1\n")
    with pytest.raises(ValueError, match="TestCode"):
        readers.read_labs(spark, str(tmp_path))


def test_claim_pages(spark, tmp_path):
    claim = {"claimId": "X", "patientMRN": "MR-5", "hospitalCode": "GROUP-MDU", "procedureCode": " 71020 ", "diagnosisCode": "S52.5",
             "claimDate": "2023-09-02", "claimAmount": 812.5, "status": "PAID", "payerCode": "PAY-2", "attendingPhysicianId": "DR-8",
             "submissionTimestamp": "2023-09-02T05:06:00Z", "lastUpdated": "2023-09-03T05:06:00Z"}
    for page in (1, 2):
        write(tmp_path / f"page{page}.json", json.dumps({"meta": {"page": page, "totalRecords": 3}, "data": [claim | {"claimId": f"C{page}{i}"} for i in range(page)]}, indent=1))
    rows = readers.read_claim_pages(spark, str(tmp_path)).orderBy("claim_id").collect()
    assert [r["claim_id"] for r in rows] == ["C10", "C20", "C21"]
    r = rows[0]
    assert (r["hospital_code"], r["procedure_code"], r["claim_amount_inr"]) == ("MDU", "71020", Decimal("812.50"))
    assert r["submission_ts"] == dt.datetime(2023, 9, 2, 5, 6)


def test_appointments(spark, tmp_path):
    path = write(tmp_path / "a.json", '[{"id":"A1","patientSnapshot":{"mrn":"M1","name":"R"},"modifiedTimestamp":"2024-01-15","_etag":"x"}]')
    r = readers.read_appointments(spark, path).first()
    assert (r["appointment_id"], r["patient_mrn_src"], r["patient_name_raw"], r["modified_ts"]) == ("A1", "M1", "R", dt.datetime(2024, 1, 15))
    assert "_etag" not in r.asDict()


def test_telemetry(spark, tmp_path):
    path = write(tmp_path / "v.json", '[{"deviceId":"ICU-01","body":{"heartRate":75,"spO2":98,"temperature":37.25}}]')
    r = readers.read_telemetry(spark, path).first()
    assert (r["device_id"], r["heart_rate_bpm"], r["spo2_pct"], r["patient_mrn_src"]) == ("ICU-01", 75, Decimal("98.00"), None)
    assert r["temperature_celsius"] == Decimal("37.3")


def test_pharmacy_changes(spark, tmp_path):
    path = write(tmp_path / "c.json", '[{"__op":"I","drug_id":"D1","current_stock_qty":50,"updated_at":"2024-01-15"},{"__op":"D","drug_id":"D2","__before":"{\\"a\\":1}"}]')
    rows = readers.read_pharmacy_changes(spark, path).orderBy("drug_id").collect()
    assert [(r["op"], r["op_type"], r["current_stock_qty"]) for r in rows] == [("c", "I", 50), ("d", "D", None)]


def test_roster(spark, tmp_path):
    path = write(tmp_path / "r.csv", "Employee ID,Full Name,Department,Hospital,Week Start Date\n,,merged title,,\nEmployee ID,Full Name,Department,Hospital,Week Start Date\nS-77,Ines Okoro,Radiology,Madurai,04-09-2023\n")
    rows = readers.read_roster(spark, path).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["employee_id"], r["department"], r["hospital_code"], r["week_start_date"]) == ("S-77", "RADIOLOGY", "MDU", dt.date(2023, 9, 4))


def test_mapping_reports_missing_columns(spark):
    with pytest.raises(ValueError, match="b"):
        mappings.map_columns(spark.createDataFrame([(1,)], "a int"), [("b", "b", "int")])


def test_bronze_partitions_evolve_and_prune(spark, tmp_path):
    root = str(tmp_path)
    first = readers.with_lineage(spark.createDataFrame([(1,)], "a int"), "S", "r1", F.lit("2024-01-15 03:00:00"))
    later = readers.with_lineage(spark.createDataFrame([(2, "x")], "a int, b string"), "S", "r2", F.lit("2024-01-16 03:00:00"))
    sinks.append_bronze(first, root, "s")
    sinks.append_bronze(later, root, "s")
    assert sorted((r["a"], r["b"]) for r in readers.read_bronze(spark, root, "s").collect()) == [(1, None), (2, "x")]
    day = readers.read_bronze(spark, root, "s", "2024-01-16")
    assert [r["a"] for r in day.collect()] == [2]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_load_date" in plan


def test_replace_table_may_read_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        sinks.read_current(spark, path)
    sinks.replace_table(spark.range(3), path)
    sinks.replace_table(sinks.read_current(spark, path).withColumn("x", F.lit(1)), path)
    assert sinks.current_version(spark, path) == 1
    assert sinks.read_current(spark, path).columns == ["id", "x"]
    assert sinks.read_current(spark, path).count() == 3
    sinks.replace_table(spark.createDataFrame([(9, 2, "drop")], "id int, x int, y string"), path, keep_schema=True)
    assert sinks.read_current(spark, path).dtypes == [("id", "bigint"), ("x", "int")]


def test_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path)
    with pytest.raises(Exception):
        sinks.replace_table(spark.range(3).select(F.raise_error(F.lit("boom")).alias("id")), path)
    assert sinks.read_current(spark, path).count() == 3


def test_missing_tables_are_empty(spark, tmp_path):
    schema = spark.range(0).schema
    assert readers.read_or_empty(spark, str(tmp_path / "none"), schema).count() == 0
    assert readers.read_table_or_empty(spark, "no_such_table", schema).count() == 0


def test_stage_export_and_clustering(spark, tmp_path):
    written = sinks.stage_export({"a": spark.range(5), "b": spark.range(2)}, str(tmp_path))
    assert {n: spark.read.parquet(p).count() for n, p in written.items()} == {"a": 5, "b": 2}
    clustered = sinks.clustered(spark.range(100).withColumn("k", F.col("id") % 7), ["k"], 4)
    spread = clustered.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.countDistinct("p").alias("n"))
    assert spread.filter("n > 1").count() == 0


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS buckets LOCATION '%s'" % tmp_path)
    for name in ("l", "r"):
        sinks.save_bucketed(spark.range(100).withColumnRenamed("id", "k").withColumn(name, F.lit(1)), f"buckets.{name}", ["k"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("buckets.l").join(spark.table("buckets.r"), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE buckets CASCADE")


def test_rejected_rows_keep_the_input_whole(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, ok boolean")
    valid, rejected = sinks.split_rejected(df, "ok", "why")
    assert [r["id"] for r in valid.collect()] == [1]
    assert [(r["id"], r["rejection_reason"]) for r in rejected.orderBy("id").collect()] == [(2, "why"), (3, "why")]


def test_kafka_options():
    plain = kafka.kafka_options("host:9092", "icu.vitals", "g", rate_cap=kafka.RATE_CAP["vitals"])
    assert plain["maxOffsetsPerTrigger"] == "5000" and "kafka.security.protocol" not in plain
    assert kafka.kafka_options("h", "t", "g", sasl_jaas="j")["kafka.sasl.mechanism"] == "PLAIN"


def test_bronze_to_silver_twice(spark, tmp_path):
    """Two loads of the patient feed: a moved patient gets a second version, nothing else changes."""
    raw = readers.read_patients(spark, write(tmp_path / "p.csv", PATIENTS))
    first = layers.bronze_patients(raw, "1900-01-01 00:00:00", "run1", F.lit("2024-02-21 03:00:00"))
    dim = layers.silver_patients(None, first, "2024-02-21")
    path = str(tmp_path / "dim")
    sinks.replace_table(dim, path)
    moved = raw.filter("patient_id_src = 'HIS-CHN-70'").withColumns(
        {"city": F.lit("ERODE"), "updated_at": F.lit("2024-02-22 10:00:00").cast("timestamp")})
    second = layers.bronze_patients(raw.unionByName(moved), "2024-02-20 07:45:00", "run2", F.lit("2024-02-23 03:00:00"))
    assert second.count() == 1
    sinks.replace_table(layers.silver_patients(sinks.read_current(spark, path), second, "2024-02-23"), path)
    rows = sinks.read_current(spark, path).filter("global_patient_id = 'HIS-CHN-70'").orderBy("eff_start_date").collect()
    assert [(r["city"], r["is_current"], r["eff_end_date"]) for r in rows] == [
        ("CHENNAI", 0, dt.date(2024, 2, 23)), ("ERODE", 1, None)]
    assert rows[0]["phone_number"] == "XXXXXX4321"
    assert sinks.read_current(spark, path).count() == 4
    again = layers.silver_patients(sinks.read_current(spark, path), second, "2024-02-23")
    assert again.count() == 4
    ids = layers.match_patients(first)
    assert ids.select("global_patient_id").distinct().count() == 3
    assert layers.with_global_ids(sinks.read_current(spark, path), ids).count() == 4


def test_replay_from_bronze(spark, tmp_path):
    """A dimension lost or broken is rebuilt from all bronze rows."""
    rows = [("p", "A", dt.date(2024, 1, 1), 1), ("p", "B", dt.date(2024, 1, 2), 2), ("p", "B", dt.date(2024, 1, 3), 3)]
    bronze = spark.createDataFrame(rows, "id string, city string, _load_date date, seq int")
    out = scd.rebuild_type2(bronze, "id", ["city"], "_load_date", ["_load_date", "seq"]).orderBy("eff_start_date").collect()
    assert [(r["city"], r["eff_end_date"]) for r in out] == [("A", dt.date(2024, 1, 2)), ("B", None)]
