"""Loads published by bucket: which files change, which stay, and what a failed load leaves."""

import pytest
from pyspark.sql import functions as F

from carelake.functions.text import record_hash
from carelake.operators import scd
from carelake.sources import buckets



def closed():
    return F.col("is_current") == 0


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("part-*.parquet") if "_loads" not in str(p) and "_layout" not in str(p)}


def dimension(spark, n):
    return spark.range(n).select(
        F.col("id").alias("k"), F.lit("old").alias("city"), F.lit("2020-01-01").cast("date").alias("eff_start_date"),
        F.lit(None).cast("date").alias("eff_end_date"), F.lit(1).alias("is_current")).withColumn("record_hash", record_hash("city"))


def load(path, delta, day):
    return buckets.merge(str(path), delta, day, lambda now, d: scd.apply_type2(now, d, "k", ["city"], F.lit(day).cast("date")), closed())


def moved(spark, keys, city):
    return spark.createDataFrame([(k, city) for k in keys], "k long, city string")


def history(spark, path):
    return sorted((r.k, r.city, str(r.eff_start_date), str(r.eff_end_date), r.is_current) for r in buckets.read(spark, str(path)).collect())


def test_only_buckets_of_changed_keys_are_rewritten(spark, tmp_path):
    path = tmp_path / "dim"
    whole = dimension(spark, 200)
    buckets.create(whole, str(path), "k", 16, closed())
    first = files(path)
    touched = load(path, moved(spark, [3, 4], "new"), "2024-01-01")
    second = files(path)
    gone = {f for f in first if f not in second}
    assert gone and {int(f.split("/")[0].split("=")[1]) for f in gone} == set(touched) and len(touched) <= 2
    assert all(second[f] == t for f, t in first.items() if f not in gone)
    load(path, moved(spark, [3, 900], "newer"), "2024-02-01")
    third = files(path)
    ended = {f: t for f, t in second.items() if "closed" in f}
    assert ended and all(third[f] == t for f, t in ended.items())  # history is never written again
    want = scd.apply_type2(scd.apply_type2(whole, moved(spark, [3, 4], "new"), "k", ["city"], F.lit("2024-01-01").cast("date")),
                           moved(spark, [3, 900], "newer"), "k", ["city"], F.lit("2024-02-01").cast("date"))
    assert history(spark, path) == sorted((r.k, r.city, str(r.eff_start_date), str(r.eff_end_date), r.is_current) for r in want.collect())
    log = {r.load_id: (r.closed, r.buckets) for r in buckets.loads(spark, str(path)).collect()}
    assert log == {"2024-01-01": (2, len(touched)), "2024-02-01": (1, 2)}


def test_an_empty_load_changes_nothing(spark, tmp_path):
    buckets.create(dimension(spark, 20), str(tmp_path / "dim"), "k", 4, closed())
    before = files(tmp_path / "dim")
    assert load(tmp_path / "dim", moved(spark, [], "x"), "2024-01-01") == [] and files(tmp_path / "dim") == before


@pytest.mark.parametrize("stores", [1, 2])
def test_a_load_that_failed_is_run_again(spark, tmp_path, monkeypatch, stores):
    """It breaks off before it replaces the current rows, or after that and before its entry in the log."""
    path = tmp_path / "dim"
    buckets.create(dimension(spark, 50), str(path), "k", 4, closed())
    done, real = [], buckets._store

    def breaking(df, to, mode):
        real(df, to, mode)
        done.append(1)
        if len(done) == stores:
            raise RuntimeError

    monkeypatch.setattr(buckets, "_store", breaking)
    with pytest.raises(RuntimeError):
        load(path, moved(spark, [1, 2], "new"), "2024-01-01")
    monkeypatch.setattr(buckets, "_store", real)
    load(path, moved(spark, [1, 2], "new"), "2024-01-01")
    rows = history(spark, path)
    assert len(rows) == 52 and sum(r[4] for r in rows) == 50
    assert [r for r in rows if r[0] == 1] == [(1, "new", "2024-01-01", "None", 1), (1, "old", "2020-01-01", "2024-01-01", 0)]


def test_current_rows_are_found_by_partition(spark, tmp_path):
    buckets.create(dimension(spark, 20), str(tmp_path / "dim"), "k", 4, closed())
    load(tmp_path / "dim", moved(spark, [1], "new"), "2024-01-01")
    rows = buckets.read(spark, str(tmp_path / "dim"), current_only=True)
    assert rows.count() == 20 and "PartitionFilters: [isnotnull(_state" in rows._jdf.queryExecution().toString()
