import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from carelake.operators import cdc, joins, scd

D = dt.date


def day(text):
    return F.lit(text).cast("date")


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def loaded(spark):
    first = spark.createDataFrame([("p1", "Chennai"), ("p2", "Madurai"), ("p3", None)], "id string, city string")
    dim = scd.apply_type2(scd.empty_dimension(first), first, "id", ["city"], day("2024-01-01"))
    return spark.createDataFrame(dim.collect(), dim.schema)


def test_first_load_opens_one_version_per_key(loaded):
    rows = loaded.collect()
    assert len(rows) == 3
    assert all(r["is_current"] == 1 and r["eff_end_date"] is None for r in rows)


def test_type2_change(spark, loaded):
    delta = spark.createDataFrame([("p1", "Salem"), ("p2", "Madurai"), ("p4", "Erode")], "id string, city string")
    out = scd.apply_type2(loaded, delta, "id", ["city"], day("2024-02-01"))
    got = {(r["id"], r["city"]): (r["eff_start_date"], r["eff_end_date"], r["is_current"]) for r in out.collect()}
    assert got == {
        ("p1", "Chennai"): (D(2024, 1, 1), D(2024, 2, 1), 0),
        ("p1", "Salem"): (D(2024, 2, 1), None, 1),
        ("p2", "Madurai"): (D(2024, 1, 1), None, 1),
        ("p3", None): (D(2024, 1, 1), None, 1),
        ("p4", "Erode"): (D(2024, 2, 1), None, 1),
    }
    assert table(scd.apply_type2(out, delta, "id", ["city"], day("2024-02-01"))) == table(out)


def test_type2_to_and_from_null(spark, loaded):
    delta = spark.createDataFrame([("p1", None), ("p3", "Salem")], "id string, city string")
    out = scd.apply_type2(loaded, delta, "id", ["city"], day("2024-02-01"))
    assert out.filter("is_current = 1").count() == 3
    assert out.filter("is_current = 0").count() == 2


def test_events_a_b_a_gives_three_versions(spark):
    rows = [("c1", "A", D(2024, 1, 1), 1), ("c1", "B", D(2024, 1, 5), 2), ("c1", "A", D(2024, 1, 9), 3), ("c1", "A", D(2024, 1, 10), 4)]
    events = spark.createDataFrame(rows, "id string, status string, d date, seq int")
    out = scd.apply_type2_events(scd.empty_dimension(events.select("id", "status")), events, "id", ["status"], "d", ["seq"])
    assert [(r["status"], r["eff_start_date"], r["eff_end_date"]) for r in out.orderBy("eff_start_date").collect()] == [
        ("A", D(2024, 1, 1), D(2024, 1, 5)), ("B", D(2024, 1, 5), D(2024, 1, 9)), ("A", D(2024, 1, 9), None)]


def test_events_in_any_split_match_the_rebuild(spark):
    rng = random.Random(11)
    rows = [(f"k{rng.randrange(4)}", rng.choice("ABC"), D(2024, 1, 1) + dt.timedelta(days=rng.randrange(25)), i) for i in range(60)]
    events = spark.createDataFrame(rows, "id string, status string, d date, seq int")
    full = scd.rebuild_type2(events, "id", ["status"], "d", ["d", "seq"])
    want = table(full)
    dim = scd.empty_dimension(events.select("id", "status"))
    for lo, hi in [(1, 9), (9, 12), (12, 26)]:
        batch = events.filter((F.dayofmonth("d") >= lo) & (F.dayofmonth("d") < hi))
        dim = scd.apply_type2_events(dim, batch, "id", ["status"], "d", ["seq"])
        dim = spark.createDataFrame(dim.collect(), dim.schema)
        again = scd.apply_type2_events(dim, batch, "id", ["status"], "d", ["seq"])
        assert table(again) == table(dim)
    assert table(dim.select(full.columns)) == want


def test_late_event_finds_its_place(spark):
    made = spark.createDataFrame([("k", "A", D(2024, 1, 1), 1), ("k", "B", D(2024, 3, 1), 2)], "id string, status string, d date, seq int")
    dim = scd.apply_type2_events(scd.empty_dimension(made.select("id", "status")), made, "id", ["status"], "d", ["seq"])
    late = spark.createDataFrame([("k", "C", D(2024, 2, 1), 3)], "id string, status string, d date, seq int")
    out = scd.apply_type2_events(dim, late, "id", ["status"], "d", ["seq"]).orderBy("eff_start_date").collect()
    assert [(r["status"], r["eff_end_date"], r["is_current"]) for r in out] == [
        ("A", D(2024, 2, 1), 0), ("C", D(2024, 3, 1), 0), ("B", None, 1)]


def test_provider_dimension_uses_the_same_core(spark):
    """Type 2 on department and hospital; contact data follows as type 1."""
    first = spark.createDataFrame([("d1", "Cardio", "CHN", "a@x.in")], "physician_id string, department_code string, hospital_code string, email string")
    dim = scd.apply_type2(scd.empty_dimension(first), first, "physician_id", scd.PROVIDER_TRACKED, day("2024-01-01"))
    moved = first.withColumns({"department_code": F.lit("ICU"), "email": F.lit("b@x.in")})
    out = scd.apply_type2(dim, moved, "physician_id", scd.PROVIDER_TRACKED, day("2024-02-01"))
    assert [(r["department_code"], r["is_current"]) for r in out.orderBy("eff_start_date").collect()] == [("Cardio", 0), ("ICU", 1)]
    again = scd.apply_type2(out, moved.withColumn("email", F.lit("c@x.in")), "physician_id", scd.PROVIDER_TRACKED, day("2024-03-01"))
    assert again.count() == 2


def test_intervals_never_overlap(spark, tables):
    from carelake.catalog.relational import plan_versions

    v = plan_versions(tables)
    a, b = v.alias("a"), v.alias("b")
    clash = a.join(b, F.col("a.patient_id") == F.col("b.patient_id")).filter(
        (F.col("a.eff_start_date") < F.col("b.eff_start_date"))
        & (F.coalesce("a.eff_end_date", day("9999-12-31")) > F.col("b.eff_start_date")))
    assert clash.count() == 0


def test_type1_keeps_and_adds(spark):
    dim = spark.createDataFrame([("p1", "1", "x"), ("p2", "2", "y")], "id string, phone string, note string")
    delta = spark.createDataFrame([("p1", "9"), ("p3", "3")], "id string, phone string")
    assert table(scd.apply_type1(dim, delta, "id", ["phone"])) == [("p1", "9", "x"), ("p2", "2", "y"), ("p3", "3", None)]


def test_type3_moves_only_on_change(spark):
    dim = spark.createDataFrame([("d1", 5.0, None, None), ("d2", 6.0, 4.0, D(2024, 1, 1)), ("d3", None, None, None)],
                                "id string, current_price double, previous_price double, price_changed_at date")
    delta = spark.createDataFrame([("d1", 7.0), ("d2", 6.0), ("d3", 1.0)], "id string, price double")
    assert table(scd.apply_type3(dim, delta, "id", "price", day("2024-05-01"))) == [
        ("d1", 7.0, 5.0, D(2024, 5, 1)), ("d2", 6.0, 4.0, D(2024, 1, 1)), ("d3", 1.0, None, D(2024, 5, 1))]


def test_type3_starts_new_keys(spark):
    dim = spark.createDataFrame([("d1", 5.0, None, None)], "id string, current_price double, previous_price double, price_changed_at date")
    delta = spark.createDataFrame([("d9", 3.0)], "id string, price double")
    assert table(scd.apply_type3(dim, delta, "id", "price", day("2024-05-01"))) == [("d1", 5.0, None, None), ("d9", 3.0, None, None)]


def test_status_moves_of_one_day_are_all_kept(spark):
    rows = [("c", s, dt.datetime(2024, 1, 1, h), h) for h, s in ((8, "A"), (9, "B"), (10, "A"), (11, "A"))]
    out = scd.rebuild_type2(spark.createDataFrame(rows, "id string, status string, at timestamp, seq int"), "id", ["status"], "at", ["seq"])
    got = sorted((r["eff_start_date"].hour, r["status"], r["is_current"]) for r in out.collect())
    assert got == [(8, "A", 0), (9, "B", 0), (10, "A", 1)]


def test_snapshot_is_half_open(spark, loaded):
    delta = spark.createDataFrame([("p1", "Salem")], "id string, city string")
    out = scd.apply_type2(loaded, delta, "id", ["city"], day("2024-02-01"))
    city = lambda d: scd.snapshot(out, d).filter("id = 'p1'").first()["city"]
    assert (city("2024-01-31"), city("2024-02-01")) == ("Chennai", "Salem")


def test_as_of_join_against_brute_force(spark):
    rng = random.Random(5)
    versions = []
    for k in range(5):
        cuts = sorted(rng.sample(range(3000), 4))
        for i, c in enumerate(cuts):
            end = D(2015, 1, 1) + dt.timedelta(days=cuts[i + 1]) if i + 1 < len(cuts) else None
            versions.append((k, f"v{k}-{i}", D(2015, 1, 1) + dt.timedelta(days=c), end))
    facts = [(i, rng.randrange(6), D(2014, 6, 1) + dt.timedelta(days=rng.randrange(4000))) for i in range(200)]
    v = spark.createDataFrame(versions, "k int, label string, eff_start_date date, eff_end_date date")
    f = spark.createDataFrame(facts, "id int, k int, d date")
    got = {r["id"]: r["label"] for r in joins.as_of_versions(f, v, "k", "d").collect()}
    want = {i: next((lb for kk, lb, s, e in versions if kk == k and s <= d and (e is None or d < e)), None) for i, k, d in facts}
    assert got == want


def test_recent_event_flag(spark):
    at = dt.datetime(2024, 1, 1, 12, 0)
    offsets = [0, 1, 3599, 3600, -1, 7200]
    df = spark.createDataFrame([(i, "p", at + dt.timedelta(seconds=s)) for i, s in enumerate(offsets)] + [(99, "q", at)],
                               "id int, k string, at timestamp")
    events = spark.createDataFrame([("p", at), ("p", at), ("p", None)], "k string, ts timestamp")
    out = joins.recent_event_flag(df, events, "k", "at", "ts", 3600, "f")
    assert {r["id"]: r["f"] for r in out.collect()} == {0: 1, 1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 99: 0}


def test_orphans_counts_rows(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert table(joins.orphans(child, spark.createDataFrame([(2,)], "k int"), "k")) == [(1, 2)]


CHANGE = "k string, op string, ts_ms long, offset long, qty int"


@pytest.mark.parametrize("ops, expected", [
    ("cudc", (4, False)), ("cud", (2, True)), ("d", None), ("cd", (1, True)), ("u", (1, False)), ("rd", (1, True))])
def test_merge_of_a_new_key(spark, ops, expected):
    target = spark.createDataFrame([("old", 9, False)], "k string, qty int, _is_deleted boolean")
    rows = [("n", op, 5, i, None if op == "d" else i + 1) for i, op in enumerate(ops)]
    for perm in itertools.islice(itertools.permutations(rows), 3):
        out = cdc.merge_changes(target, spark.createDataFrame(list(perm), CHANGE), "k", ["qty"])
        got = {r["k"]: (r["qty"], r["_is_deleted"]) for r in out.collect()}
        assert got.pop("old") == (9, False)
        assert got == ({} if expected is None else {"n": expected})


def test_merge_deletes_and_revives_known_keys(spark):
    target = spark.createDataFrame([("a", 1, False), ("b", 2, True)], "k string, qty int, _is_deleted boolean")
    changes = spark.createDataFrame([("a", "d", 1, 1, None), ("b", "u", 1, 2, 7)], CHANGE)
    out = cdc.merge_changes(target, changes, "k", ["qty"])
    assert table(out) == [("a", 1, True), ("b", 7, False)]
    assert table(cdc.merge_changes(out, changes, "k", ["qty"])) == table(out)


def test_file_operation_codes(spark):
    df = spark.createDataFrame([("I",), ("U",), ("D",), ("r",), ("?",)], "op string")
    assert [r[0] for r in df.select(cdc.normalise_op(F.col("op"))).collect()] == ["c", "u", "d", "r", None]
