"""Ordered operators against brute force, with one key that owns most rows and every key treated as hot."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from carelake.operators import aggregates, ordered


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for i in range(600):
        key = "hot" if rng.random() < 0.6 else f"k{rng.randrange(60)}"
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.choice([0, 0, 0, 3, 9, 40, 41, 200]))
        out.append((key, day, i, rng.choice([None, 1, 2, 5])))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, d date, id int, v int")


def by_key(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


@pytest.mark.parametrize("hot_rows", [0, 5, 100, 10**6])
def test_previous_and_next(frame, rows, hot_rows):
    prev = ordered.previous_values(frame, ["k"], ["d", "id"], {"pv": "v", "pid": "id"}, hot_rows)
    both = ordered.next_values(prev, ["k"], ["d", "id"], {"nid": "id"}, hot_rows)
    got = {r["id"]: (r["pv"], r["pid"], r["nid"]) for r in both.collect()}
    want = {}
    for group in by_key(rows).values():
        for i, r in enumerate(group):
            before = group[i - 1] if i else None
            after = group[i + 1] if i + 1 < len(group) else None
            want[r[2]] = (before and before[3], before and before[2], after and after[2])
    assert got == want


@pytest.mark.parametrize("hot_rows", [0, 5, 100, 10**6])
def test_running(frame, rows, hot_rows):
    total = ordered.running_total(frame, ["k"], ["d", "id"], F.coalesce("v", F.lit(0)), "t", hot_rows)
    out = ordered.running_max(total, ["k"], ["d", "id"], F.col("v"), "m", hot_rows)
    got = {r["id"]: (r["t"], r["m"]) for r in out.collect()}
    want = {}
    for group in by_key(rows).values():
        t, m = 0, None
        for r in group:
            t += r[3] or 0
            m = r[3] if m is None else m if r[3] is None else max(m, r[3])
            want[r[2]] = (t, m)
    assert got == want


def test_hot_keys_only_lists_keys_over_the_limit(frame, rows):
    hot = {r["k"] for r in ordered.hot_keys(frame, ["k"], 100).collect()}
    assert hot == {"hot"}


def test_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None, dt.date(2024, 1, 1), 1, 7), (None, dt.date(2024, 1, 2), 2, 8)],
                               "k string, d date, id int, v int")
    out = ordered.previous_values(df, ["k"], ["d", "id"], {"pv": "v"}).orderBy("id").collect()
    assert [r["pv"] for r in out] == [None, 7]


def test_latest_per_key(frame, rows):
    got = {r["k"]: r["id"] for r in ordered.latest_per_key(frame, ["k"], ["d", "id"]).collect()}
    assert got == {k: g[-1][2] for k, g in by_key(rows).items()}


@pytest.mark.parametrize("width", [1, 7, 1000])
@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
def test_exact_percentile(spark, p, width):
    rng = random.Random(3)
    rows = [("hot", rng.choice([1, 2, 2, 2, 3, 50, 51, 999])) for _ in range(300)]
    rows += [("one", 5), ("two", 1), ("two", 4), ("nul", None)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = {r["k"]: r["p"] for r in aggregates.exact_percentile(df, ["k"], "v", p, "p", width).collect()}
    want = {r["k"]: r["p"] for r in df.filter("v IS NOT NULL").groupBy("k").agg(F.percentile("v", p).alias("p")).collect()}
    assert got == pytest.approx(want)


def test_trailing_days(spark):
    days = [0, 0, 3, 6, 7, 20]
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1) + dt.timedelta(days=d)) for d in days], "k string, d date")
    out = aggregates.trailing_days(df, ["k"], "d", 7, "n").orderBy("d").collect()
    assert [r["n"] for r in out] == [2, 3, 4, 3, 1]


def test_rolling_months_fills_gaps(spark):
    df = spark.createDataFrame([("a", dt.date(2023, 1, 1), 5), ("a", dt.date(2024, 2, 1), 7)], "k string, m date, n long")
    out = aggregates.rolling_months(df, ["k"], "m", {"n12": "n"}).orderBy("m").collect()
    assert len(out) == 14
    assert [r["n12"] for r in out][:13] == [5] * 12 + [0]
    assert out[-1]["n12"] == 7
