"""Replays, late events, windows and restarts in a started pipeline."""

import datetime as dt
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.streaming import events, parse, runtime, windows

from test_streaming import AT, log_rows, reading, source


def at(minute, i=0, **changes):
    return reading(i, recorded_at=(AT + dt.timedelta(minutes=minute)).isoformat(), **changes)


FILES = [
    [(i, at(i)) for i in range(15)],
    [(i, at(i)) for i in range(10, 15)] + [(15 + i, at(15 + i)) for i in range(15)],  # five replays
    [(30, at(50)), (31, at(49, spo2=50.0)), (32, b"not json")],
    [(33, at(2)), (34, at(44)), (35, at(46)), (12, at(12))],  # the first two are late, and so is the replay
    [(36, at(52)), (35, at(46))],
    [(37, at(95))],
]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Files arrive one by one, with a restart before each; the last restart finds nothing new."""
    folder = tmp_path_factory.mktemp("events")
    spec = events.EventSpec("vitals", str(folder / "out"), "run", "5 minutes")
    route = runtime.vitals_spec(str(folder / "out"), "run")
    dropped = 0
    for rows in [*FILES, []]:
        if rows:
            parts = [log_rows(spark, [value], offset) for offset, value in rows]
            reduce(DataFrame.unionByName, parts).coalesce(1).write.mode("append").parquet(str(folder / "src"))
        queries = events.start_pipeline(
            parse.vitals(source(spark, folder / "src"), "run"), spec, runtime.route_batch(route), str(folder / "cp"), mode="batch")
        assert all(q.exception() is None for q in queries)
        dropped += sum(events.dropped_behind_watermark(q) for q in queries[1:])
    return spec, route, dropped


def offsets(spark, path):
    return sorted(r[0] for r in spark.read.parquet(path).select("offset").collect())


def test_each_log_position_comes_through_once(spark, made):
    spec, route, _ = made
    got = offsets(spark, route.folder("bronze")) + offsets(spark, route.folder("dlq"))
    assert sorted(got) == [i for i in range(38) if i not in (32, 33, 34)]


def test_late_events_are_kept_and_counted(spark, made):
    spec, route, dropped = made
    late = {(r.offset, r.rejection_reason) for r in spark.read.parquet(spec.folder("late")).collect()}
    assert late == {(32, events.UNTIMED), (33, events.LATE), (34, events.LATE), (12, events.LATE)}
    assert dropped == 0  # what the intake let pass is late for no one
    audit = spark.read.parquet(spec.folder("intake_audit")).agg(
        F.sum("records_read"), F.sum("records_written"), F.sum("records_rejected")).first()
    assert audit[:] == (sum(map(len, FILES)), sum(map(len, FILES)) - 4, 4)


def test_windows_are_complete_when_they_are_written(spark, made):
    spec, _, _ = made
    got = spark.read.parquet(spec.folder("windows"))
    unique = {o: v for r in FILES for o, v in r if o not in (32, 33, 34)}
    batch = parse.vitals(log_rows(spark, list(unique.values())), "run").where("dq_passed")
    want = windows.window_summary(batch, "15 minutes").where(F.col("window_end") <= F.lit(AT + dt.timedelta(minutes=90)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 3


def test_a_repeated_intake_batch_meets_the_same_mark(spark, tmp_path):
    spec = events.EventSpec("v", str(tmp_path), "run", "5 minutes")
    process = events.intake(spec)
    first, second = (parse.vitals(log_rows(spark, [v for _, v in FILES[i]]), "run") for i in (2, 3))
    process(first, 0)
    for _ in range(2):
        process(second, 1)
    assert spark.read.parquet(spec.folder("late")).count() == 4 and spark.read.parquet(spec.folder("intake")).count() == 3
