"""Erasure by file: what is rewritten, what is proved, and what stays as it was."""

from pyspark.sql import functions as F

from carelake.sources import erasure

from test_buckets import files


def test_only_partitions_that_hold_a_subject_are_rewritten(spark, tmp_path):
    rows = [(1, "2024-01-01", "a:b"), (2, "2024-01-01", "a:b"), (1, "2024-01-02", "01"), (3, "2024-01-03", "1"), (2, "2024-01-03", None),
            (None, "2024-01-03", None), (2, "2024-01-03", "a:b")]
    events = tmp_path / "events"
    spark.createDataFrame(rows, "who long, day string, site string").withColumn("v", F.lit("x")).coalesce(1).write.partitionBy(
        "day", "site").parquet(str(events))
    log = tmp_path / "changes"
    spark.createDataFrame([(1, "u"), (2, "u"), (1, "d")], "who long, op string").coalesce(1).write.parquet(str(log))
    before = files(events)
    subjects = spark.createDataFrame([(1,), (1,), (77,), (None,)], "who long")
    manifest = erasure.erase_stored(spark, {"events": (str(events), "who"), "changes": (str(log), "who")}, subjects, "run-1").collect()
    got = {(r.table_name, r.partition): (r.files, r.rows_before, r.rows_erased, r.rows_left, r.verified) for r in manifest}
    assert got == {("events", "day=2024-01-01/site=a:b"): (1, 2, 1, 1, True), ("events", "day=2024-01-02/site=01"): (1, 1, 1, 0, True),
                   ("changes", ""): (1, 3, 2, 1, True)}
    after = files(events)
    same = {f for f, t in before.items() if after.get(f) == t}
    assert {f.rsplit("/", 1)[0] for f in before if f not in same} == {"day=2024-01-01/site=a%3Ab", "day=2024-01-02/site=01"}
    left = [(r.who, str(r.day)) for r in spark.read.parquet(str(events)).collect()]
    assert sorted(left, key=str) == sorted([(w, d) for w, d, _ in rows if w != 1], key=str)
    assert [tuple(r) for r in spark.read.parquet(str(log)).collect()] == [(2, "u")]
    again = erasure.erase_stored(spark, {"events": (str(events), "who")}, subjects, "run-2")
    assert again.count() == 0 and files(events) == after


def test_calendar(spark):
    from carelake.operators import calendar

    off = spark.createDataFrame([("2024-01-01",), ("2024-01-01",), ("2024-01-06",), (None,)], "day string")
    days = calendar.business_calendar(spark, "2023-12-28", "2024-01-10", off)
    rows = [(1, "2023-12-29", "2024-01-03"), (2, "2024-01-03", "2023-12-29"), (3, "2024-01-05", "2024-01-08"), (4, None, "2024-01-02"),
            (5, "2024-01-02", "2025-01-01"), (6, "2024-01-02", "2024-01-02")]
    df = spark.createDataFrame(rows, "id int, a string, b string").withColumns({c: F.col(c).cast("date") for c in "ab"})
    got = {r.id: r.n for r in calendar.with_business_days(df, days, "a", "b", "n").collect()}
    assert got == {1: 2, 2: -2, 3: 1, 4: None, 5: None, 6: 0}
