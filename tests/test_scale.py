"""Behaviour under skew: one key holds a third of the rows."""

import pytest
from pyspark.sql import functions as F

from carelake.operators import aggregates, joins, matching, ordered
from carelake.session import use_checkpoint_dir


@pytest.fixture
def small_limits(spark):
    """Limits of the adaptive skew split scaled down to test data."""
    values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_rows(spark, n=400000):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
    return spark.range(0, n, 1, 16).select(key.alias("k"), F.col("id").alias("v"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_summary_join_splits_the_hot_key(spark, small_limits):
    rows = hot_rows(spark)
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = joins.join_summary(rows, counts, ["k"])
    assert "skew=true" in final_plan(joined)
    assert joined.filter("k = 7").agg(F.min("n")).first()[0] == rows.filter("k = 7").count()


def test_as_of_join_splits_the_hot_key(spark, small_limits):
    facts = hot_rows(spark).withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("v") % 300).cast("int")))
    versions = spark.range(0, 1000).select(
        F.col("id").alias("k"), F.lit("2019-01-01").cast("date").alias("eff_start_date"), F.lit(None).cast("date").alias("eff_end_date"))
    joined = joins.as_of_versions(facts, versions, "k", "d")
    assert "skew=true" in final_plan(joined)


def test_summary_join_keeps_null_keys(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(r["n"] for r in joins.join_summary(rows, counts, ["k"]).collect()) == [1, 2, 2]


def test_percentile_reads_its_input_once_and_keeps_null_groups(spark):
    rows = spark.createDataFrame([(None, 1), (None, 3), ("a", 3)], "k string, v int")
    out = {r["k"]: r["p"] for r in aggregates.exact_percentile(rows, ["k"], "v", 0.5, "p", 10).collect()}
    assert out == {None: 2.0, "a": 3.0}


def test_hot_key_is_sliced_and_others_are_not(spark):
    rows = hot_rows(spark, 3000).withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("v") % 100).cast("int")))
    sliced, _ = ordered._sliced(rows, ["k"], ["d", "v"], 100)
    assert sliced.filter("k = 7 AND _slice IS NULL").count() == 0
    assert sliced.filter("k <> 7 AND _slice IS NOT NULL").count() == 0
    largest = sliced.where("k = 7").groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert largest <= 200


def test_rows_that_crowd_in_one_hour_are_spread(spark):
    """Five keys; one has nine tenths of the rows, nearly all in one hour: by that hour it would be one task."""
    n = 200_000
    at = F.when(F.col("id") % 20 < 19, 36_000 + F.col("id") % 3600).otherwise(F.col("id") % 864_000)
    rows = spark.range(n).select(F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id") % 50 / 10).cast("int").alias("k"), at.alias("s"), "id")
    hour = rows.groupBy("k", F.floor(F.col("s") / 3600)).count().agg(F.max("count")).first()[0]
    out = ordered.running_total(rows, ["k"], ["s", "id"], F.lit(1), "nth", hot_rows=2000)
    sliced, keys = ordered._sliced(rows, ["k"], ["s", "id"], 2000)
    sizes = sorted(r["count"] for r in sliced.groupBy("k", "_slice").count().collect())
    assert hour > 0.8 * n and sizes[-1] <= 2 * sizes[len(sizes) // 2] and len(sizes) >= 90
    tasks = sorted(r["count"] for r in sliced.repartition(8, *keys, "_slice").groupBy(F.spark_partition_id()).count().collect())
    assert tasks[-1] <= 2 * tasks[len(tasks) // 2]
    got = {r["id"]: (r["k"], r["nth"]) for r in out.collect()}
    want, seen = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (r["s"], r["id"])):
        seen[r["k"]] = seen.get(r["k"], 0) + 1
        want[r["id"]] = (r["k"], seen[r["k"]])
    assert got == want


def test_hot_null_key_is_sliced_and_keeps_its_order(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("v"),
                                    F.floor(F.col("id") / 100).alias("d"))
    sliced, _ = ordered._sliced(rows, ["k"], ["v"], 500)
    assert sliced.filter("k IS NULL AND _slice IS NULL").count() == 0
    cut = ordered.previous_values(rows, ["k"], ["v"], {"before": "v"}, hot_rows=500)
    whole = ordered.previous_values(rows, ["k"], ["v"], {"before": "v"})
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))
    assert cut.filter("k IS NULL AND before = v - 3").count() == 999


def test_null_key_meets_no_event(spark):
    rows = spark.createDataFrame([(None, "2024-01-01 10:00:00"), ("a", "2024-01-01 10:00:00")], "k string, at string")
    out = joins.recent_event_flag(rows, rows.withColumnRenamed("at", "e"), "k", "at", "e", 3600, "f")
    assert {r["k"]: r["f"] for r in out.collect()} == {None: 0, "a": 1}


def test_without_hot_keys_the_edge_branch_disappears(spark, tables):
    from carelake.operators import kpi

    text = final_plan(kpi.with_previous_discharge(tables.admissions))
    assert text.count("Window") == 1 and "Join" not in text


def test_dimension_is_replicated_only_below_the_limit(spark, tables):
    fact, dim = tables.raw("lineitem"), tables.raw("supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = joins.join_dimension(fact, dim, "l_suppkey")._jdf.queryExecution().executedPlan().toString()
        far = joins.join_dimension(fact, dim, "l_suppkey", limit=10)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in near and "BroadcastHashJoin" not in far


def test_literal_table(spark):
    table = joins.literal_table(spark, [("a", 1), ("b", None)], "k string, v int")
    assert table.dtypes == [("k", "string"), ("v", "int")]
    assert sorted(tuple(r) for r in table.collect()) == [("a", 1), ("b", None)]
    assert joins.plan_bytes(table) < joins.BROADCAST_BYTES
    assert joins.literal_table(spark, [], "k string").count() == 0


def test_links_of_a_hot_group_stay_linear(spark):
    """A third of the records share birth date and phone but differ in name and identifier."""
    n = 3000
    hot = F.col("id") % 3 == 0
    rows = spark.range(n).select(
        F.col("id").alias("r"), F.when(hot, "1990").otherwise(F.col("id").cast("string")).alias("b"),
        F.when(hot, "9841012345").otherwise((F.col("id") + 9000000000).cast("string")).alias("p"),
        F.translate(F.col("id").cast("string"), "0123456789", "BCDFGHJKLM").alias("f"), F.lit("RAO").alias("l"),
        F.sha2(F.col("id").cast("string"), 256).alias("h"))
    fields = matching.match_fields(rows, "r", "f", "l", "b", "p", "h")
    assert matching.match_links(fields).count() <= 8 * n


def test_checkpoint_folder_follows_the_setting(spark):
    folder = use_checkpoint_dir(spark)
    wanted = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert wanted is None or folder.split(":")[-1].startswith(wanted.split(":")[-1])


def test_rule_hits_do_not_shuffle_the_claims(spark, tables):
    """Scoring shuffles the claims once, for the discharge lookup; rule hits are replicated."""
    from carelake.catalog import QUERIES

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = QUERIES["fraud_scores"](spark, tables.folder)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Two joins build the claims of the test tables, one is the discharge lookup.
    assert text.count("SortMergeJoin") == 3
    assert text.count("BroadcastHashJoin") == 3


def test_large_claims_are_joined_once(spark, tables, monkeypatch):
    """Large claims are written before the rules read them: the joins of their tables are not made again."""
    from carelake.catalog import QUERIES
    from carelake.operators import fraud

    wanted = sorted(map(tuple, QUERIES["fraud_scores"](spark, tables.folder).collect()))
    written = []
    monkeypatch.setattr(fraud, "reused", lambda df: written.append(df.columns) or joins.reused(df, 0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = QUERIES["fraud_scores"](spark, tables.folder)
        assert scores._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1
        assert sorted(map(tuple, scores.collect())) == wanted and len(written) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reused_rows_are_written_from_a_size_on(spark, tables):
    claims = tables.claims(patient=True)
    size = joins.source_bytes(claims)
    assert 0 < size < joins.BROADCAST_BYTES  # a join's own estimate is a product
    assert joins.reused(claims) is claims
    written = joins.reused(claims, size - 1)
    assert "settled-" in written.inputFiles()[0] and written.count() == claims.count()


def test_discharges_move_only_what_the_score_needs(spark, tables):
    """The shuffle of the claims for F3 holds neither columns of other rules nor the text of the id."""
    from carelake.catalog import QUERIES

    plan = QUERIES["fraud_scores"](spark, tables.folder)._jdf.queryExecution().optimizedPlan()
    join = plan
    while join.nodeName() != "Join":
        join = join.children().apply(0)
    moved = {a.split("#")[0] for a in join.children().apply(0).output().mkString(" ").split()}
    assert "patient_id" in moved and not moved & {"diagnosis_code", "claim_amount", "procedure_code", "submission_ts", "_bucket"}


def test_settled_rows_have_a_known_size(spark):
    out = joins.settled(spark.range(10).withColumn("x", F.lit("a")))
    assert out.count() == 10 and joins.plan_bytes(out) < 10**5


def test_shuffle_partitions_only_grow(spark):
    from carelake.session import fit_shuffle

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert fit_shuffle(spark, 1000) == int(before)
        assert fit_shuffle(spark, 100 * 2**40) == 819200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
