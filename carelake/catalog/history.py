"""Slowly changing dimensions, change-data-capture and patient matching."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from carelake.catalog.bindings import ORDERS_AS_OF, Tables
from carelake.catalog.registry import query
from carelake.catalog.relational import plan_events, plan_versions
from carelake.functions.text import record_hash
from carelake.operators import cdc, matching, scd
from carelake.session import use_checkpoint_dir
from carelake.sources import buckets


@query("scd1_apply", """
    SELECT 'HIS-CHN-' || c_custkey AS person_id,
           CASE WHEN c_acctbal < 0 THEN 'new' || c_custkey || '@example.com' ELSE 'user' || c_custkey || '@example.com' END AS email,
           CASE WHEN c_acctbal < 0 THEN '99' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') ELSE '98' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS phone_number,
           c_mktsegment AS plan
    FROM customer
    UNION ALL SELECT 'SUP-' || s_suppkey, 'staff' || s_suppkey || '@example.com', '97' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0'), NULL FROM supplier""")
def scd1_apply(t: Tables):
    dim = t.patients.select(
        F.col("global_patient_id").alias("person_id"), "email", "phone_number", F.col("insurance_plan_id").alias("plan"))
    changed = t.raw("customer").filter(F.col("c_acctbal") < 0).select(
        F.concat(F.lit("HIS-CHN-"), "c_custkey").alias("person_id"),
        F.concat(F.lit("new"), "c_custkey", F.lit("@example.com")).alias("email"),
        F.concat(F.lit("99"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")).alias("phone_number"))
    added = t.raw("supplier").select(
        F.concat(F.lit("SUP-"), "s_suppkey").alias("person_id"),
        F.concat(F.lit("staff"), "s_suppkey", F.lit("@example.com")).alias("email"),
        F.concat(F.lit("97"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0")).alias("phone_number"))
    return scd.apply_type1(dim, changed.unionByName(added), "person_id", ["email", "phone_number"])


_HASH = "sha256(concat_ws('|', coalesce(city, '∅'), coalesce(plan, '∅')))"


_SCD2_SQL = f"""
    WITH base AS (SELECT global_patient_id AS person_id, city, insurance_plan_id AS plan, balance FROM patients),
    rows AS (
        SELECT person_id, 'UNKNOWN' AS city, plan, DATE '1990-01-01' AS eff_start_date, DATE '1995-01-01' AS eff_end_date, 0 AS is_current FROM base
        UNION ALL SELECT person_id, city, plan, DATE '1995-01-01', CASE WHEN balance < 0 THEN DATE '2001-12-31' END, CASE WHEN balance < 0 THEN 0 ELSE 1 END FROM base
        UNION ALL SELECT person_id, city, 'UNINSURED', DATE '2001-12-31', NULL, 1 FROM base WHERE balance < 0
        UNION ALL SELECT 'SUP-' || s_suppkey, n_name, NULL, DATE '2001-12-31', NULL, 1 FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT person_id, city, plan, eff_start_date, eff_end_date, CAST(is_current AS INTEGER) AS is_current, {_HASH} AS record_hash FROM rows"""


@query("scd2_apply", _SCD2_SQL)
def scd2_apply(t: Tables):
    return scd.apply_type2(_dimension(t), _delta(t), "person_id", ["city", "plan"], F.lit(ORDERS_AS_OF).cast("date"))


@query("scd2_bucketed", _SCD2_SQL)
def scd2_bucketed(t: Tables):
    """The same load published by bucket, and read back."""
    path = f"{use_checkpoint_dir(t.spark)}/scd2-{uuid.uuid4().hex}"
    closed = F.col("is_current") == 0
    buckets.create(_dimension(t), path, "person_id", 16, closed)
    as_of = F.lit(ORDERS_AS_OF).cast("date")
    buckets.merge(path, _delta(t), ORDERS_AS_OF, lambda now, delta: scd.apply_type2(
        now, delta, "person_id", ["city", "plan"], as_of), closed)
    return buckets.read(t.spark, path)


@query("scd2_counts", """
    SELECT (SELECT count(*) FROM supplier) AS new_keys, count(*) FILTER (c_acctbal < 0) AS expired_rows,
           2 * count(*) + count(*) FILTER (c_acctbal < 0) + (SELECT count(*) FROM supplier) AS total_rows
    FROM customer""")
def scd2_counts(t: Tables):
    as_of = F.lit(ORDERS_AS_OF).cast("date")
    return scd.load_counts(scd.apply_type2(_dimension(t), _delta(t), "person_id", ["city", "plan"], as_of), as_of)


def _dimension(t: Tables):
    """A dimension with closed history and one current row per patient."""
    base = t.patients.select(F.col("global_patient_id").alias("person_id"), "city", F.col("insurance_plan_id").alias("plan"))

    def version(df, start, end, current):
        return df.withColumns({
            "eff_start_date": F.lit(start).cast("date"), "eff_end_date": F.lit(end).cast("date"),
            "is_current": F.lit(current), "record_hash": record_hash("city", "plan")})

    return version(base.withColumn("city", F.lit("UNKNOWN")), "1990-01-01", "1995-01-01", 0).unionByName(
        version(base, "1995-01-01", None, 1))


def _delta(t: Tables):
    """Patients of a load: some unchanged, indebted ones with another plan, staff as new keys."""
    seen = t.patients.filter(F.col("balance") < 1000).select(
        F.col("global_patient_id").alias("person_id"), "city",
        F.when(F.col("balance") < 0, "UNINSURED").otherwise(F.col("insurance_plan_id")).alias("plan"))
    staff = t.raw("supplier").join(t.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("SUP-"), "s_suppkey").alias("person_id"), F.col("n_name").alias("city"),
        F.lit(None).cast("string").alias("plan"))
    return seen.unionByName(staff)


@query("scd2_rebuild", """
    SELECT patient_id, plan, eff_start_date, eff_end_date, CAST(CASE WHEN eff_end_date IS NULL THEN 1 ELSE 0 END AS INTEGER) AS is_current, record_hash
    FROM versions""")
def scd2_rebuild(t: Tables):
    return plan_versions(t)


@query("scd2_claim_status", """
    WITH moves AS (SELECT user_id AS claim_id, ts, arg_max(event_type, event_id) AS status FROM events GROUP BY ALL),
    marked AS (SELECT *, lag(status) OVER (PARTITION BY claim_id ORDER BY ts) AS before FROM moves),
    starts AS (SELECT * FROM marked WHERE before IS NULL OR before <> status)
    SELECT claim_id, status, ts AS eff_start_ts, lead(ts) OVER w AS eff_end_ts,
           CAST(CASE WHEN lead(ts) OVER w IS NULL THEN 1 ELSE 0 END AS INTEGER) AS is_current
    FROM starts WINDOW w AS (PARTITION BY claim_id ORDER BY ts)""")
def scd2_claim_status(t: Tables):
    """Every status a claim has had, by event time: a claim may move several times a day, and back."""
    moves = t.raw("events").select(
        F.col("user_id").alias("claim_id"), F.col("event_type").alias("status"), "ts", "event_id")
    return scd.rebuild_type2(moves, "claim_id", ["status"], "ts", ["event_id"]).select(
        "claim_id", "status", F.col("eff_start_date").alias("eff_start_ts"), F.col("eff_end_date").alias("eff_end_ts"),
        "is_current")


@query("scd2_plan_events", """
    SELECT patient_id, plan, eff_start_date, eff_end_date, CAST(CASE WHEN eff_end_date IS NULL THEN 1 ELSE 0 END AS INTEGER) AS is_current, record_hash
    FROM versions""")
def scd2_plan_events(t: Tables):
    """Dimension as of 1999, then all later transitions in one batch."""
    events = plan_events(t)
    cut = F.lit("1999-01-01").cast("date")
    dim = scd.rebuild_type2(events.filter(F.col("d") < cut), "patient_id", ["plan"], "d", ["d", "seq"])
    return scd.apply_type2_events(dim, events.filter(F.col("d") >= cut), "patient_id", ["plan"], "d", ["seq"])


@query("scd2_inventory", """
    WITH daily AS (
        SELECT inventory_id, CAST(ts_ms AS DATE) AS d, arg_max(CAST(floor(quantity / 100) AS BIGINT), "offset") AS band
        FROM changes WHERE op IN ('u', 'c') GROUP BY ALL),
    marked AS (SELECT *, lag(band) OVER (PARTITION BY inventory_id ORDER BY d) AS before FROM daily)
    SELECT inventory_id, band, d AS eff_start_date, lead(d) OVER (PARTITION BY inventory_id ORDER BY d) AS eff_end_date,
           CAST(CASE WHEN lead(d) OVER (PARTITION BY inventory_id ORDER BY d) IS NULL THEN 1 ELSE 0 END AS INTEGER) AS is_current,
           sha256(CAST(band AS VARCHAR)) AS record_hash
    FROM marked WHERE before IS NULL OR before <> band""")
def scd2_inventory(t: Tables):
    events = t.changes.filter(F.col("op").isin("u", "c")).select(
        "inventory_id", F.floor(F.col("quantity") / 100).alias("band"), F.col("ts_ms").cast("date").alias("d"), "offset")
    cut = F.lit("2024-01-16").cast("date")
    first = scd.empty_dimension(events.select("inventory_id", "band"))
    half = scd.apply_type2_events(first, events.filter(F.col("d") < cut), "inventory_id", ["band"], "d", ["offset"])
    return scd.apply_type2_events(half, events.filter(F.col("d") >= cut), "inventory_id", ["band"], "d", ["offset"])


@query("scd2_snapshot", """
    SELECT patient_id, plan, eff_start_date FROM versions
    WHERE eff_start_date <= DATE '1999-06-30' AND (eff_end_date IS NULL OR DATE '1999-06-30' < eff_end_date)""")
def scd2_snapshot(t: Tables):
    return scd.snapshot(plan_versions(t), "1999-06-30").select("patient_id", "plan", "eff_start_date")


@query("scd3_price", """
    SELECT p_partkey AS drug_id,
           CAST(CASE WHEN p_size > 25 THEN CAST(p_retailprice AS DECIMAL(10,2)) + 10 ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS DOUBLE) AS current_price,
           CAST(CASE WHEN p_size > 25 AND p_partkey % 7 <> 0 THEN CAST(p_retailprice AS DECIMAL(10,2)) END AS DOUBLE) AS previous_price,
           CASE WHEN p_size > 25 AND p_partkey % 7 <> 0 THEN DATE '2001-12-31' END AS price_changed_at
    FROM part""")
def scd3_price(t: Tables):
    # Every seventh drug is new on the day and in the delta only.
    dim = t.drugs.where("drug_id % 7 <> 0").select(
        "drug_id", F.col("price").alias("current_price"), F.lit(None).cast("decimal(10,2)").alias("previous_price"),
        F.lit(None).cast("date").alias("price_changed_at"))
    price = F.col("p_retailprice").cast("decimal(10,2)")
    incoming = t.raw("part").select(
        F.col("p_partkey").alias("drug_id"),
        F.when(F.col("p_size") > 25, (price + 10).cast("decimal(10,2)")).otherwise(price).alias("price"))
    out = scd.apply_type3(dim, incoming, "drug_id", "price", F.lit(ORDERS_AS_OF).cast("date"))
    return out.withColumns({c: F.col(c).cast("double") for c in ("current_price", "previous_price")})


@query("cdc_latest", """
    SELECT inventory_id, op, ts_ms, "offset", quantity FROM (
        SELECT *, row_number() OVER (PARTITION BY inventory_id ORDER BY ts_ms DESC, "offset" DESC) AS rn FROM changes) WHERE rn = 1""")
def cdc_latest(t: Tables):
    rows = t.changes.select("inventory_id", "op", "ts_ms", "offset", "quantity")
    return cdc.latest_changes(rows, "inventory_id")


_MERGE_SQL = """
    WITH target AS (SELECT c_custkey AS inventory_id, c_acctbal AS quantity, c_mktsegment AS payload, c_acctbal < 0 AS _is_deleted FROM customer),
    last AS (SELECT inventory_id, arg_max(op, "offset") AS op,
                    max("offset") FILTER (op <> 'd') AS image_offset FROM changes GROUP BY inventory_id),
    image AS (SELECT l.inventory_id, l.op, c.quantity, c.payload, c.inventory_id IS NOT NULL AS has_image
              FROM last l LEFT JOIN changes c ON c."offset" = l.image_offset AND c.op <> 'd')
    SELECT coalesce(t.inventory_id, i.inventory_id) AS inventory_id,
           CASE WHEN i.has_image THEN i.quantity ELSE t.quantity END AS quantity,
           CASE WHEN i.has_image THEN i.payload ELSE t.payload END AS payload,
           CASE WHEN i.op IS NULL THEN t._is_deleted ELSE i.op = 'd' END AS _is_deleted
    FROM target t FULL OUTER JOIN image i ON t.inventory_id = i.inventory_id
    WHERE t.inventory_id IS NOT NULL OR i.has_image"""


def _target(t: Tables):
    return t.raw("customer").select(
        F.col("c_custkey").alias("inventory_id"), F.col("c_acctbal").alias("quantity"),
        F.col("c_mktsegment").alias("payload"), (F.col("c_acctbal") < 0).alias("_is_deleted"))


@query("cdc_merge", _MERGE_SQL)
def cdc_merge(t: Tables):
    return cdc.merge_changes(_target(t), t.changes, "inventory_id", ["quantity", "payload"])


@query("cdc_bucketed", _MERGE_SQL)
def cdc_bucketed(t: Tables):
    """The changes in two loads, each published by bucket."""
    path = f"{use_checkpoint_dir(t.spark)}/cdc-{uuid.uuid4().hex}"
    buckets.create(_target(t), path, "inventory_id", 16)
    late = F.col("ts_ms") >= F.lit("2024-01-16").cast("timestamp_ntz")
    for load, part in (("1", ~late), ("2", late)):
        buckets.merge(path, t.changes.where(part), load, lambda now, changes: cdc.merge_changes(
            now, changes, "inventory_id", ["quantity", "payload"]))
    return buckets.read(t.spark, path)


@query("cdc_inserts", """
    SELECT inventory_id, "offset", ts_ms, quantity FROM changes WHERE op = 'c'""")
def cdc_inserts(t: Tables):
    return cdc.inserts_only(t.changes).select("inventory_id", "offset", "ts_ms", "quantity")


def _fields(t: Tables):
    return matching.match_fields(t.registrations, "record_id", "first_name", "last_name", "birth_date", "phone", "id_hash")


# Pairs are scored from the raw fields; nothing here knows the rules or their keys.
_SCORED_SQL = """
    fields AS (
        SELECT record_id, nullif(upper(trim(first_name)), '') AS f, nullif(upper(trim(last_name)), '') AS l, birth_date AS d,
               right(nullif(trim(phone), ''), 6) AS p, right(nullif(trim(id_hash), ''), 4) AS i
        FROM registrations),
    formed AS (
        SELECT *, CASE WHEN length(f) >= 4 THEN list_append([left(f, k - 1) || substr(f, k + 1) for k in range(1, length(f) + 1)], f) ELSE [f] END AS fn,
               CASE WHEN length(l) >= 4 THEN list_append([left(l, k - 1) || substr(l, k + 1) for k in range(1, length(l) + 1)], l) ELSE [l] END AS ln
        FROM fields),
    near AS (
        SELECT a.record_id AS x, b.record_id AS y FROM formed a JOIN formed b ON a.d = b.d AND a.p = b.p WHERE a.record_id <> b.record_id
        UNION SELECT a.record_id, b.record_id FROM formed a JOIN formed b ON a.d = b.d AND a.i = b.i WHERE a.record_id <> b.record_id
        UNION SELECT a.record_id, b.record_id FROM formed a JOIN formed b ON a.p = b.p AND a.i = b.i WHERE a.record_id <> b.record_id),
    scored AS (
        SELECT x AS record_id, y AS match_id,
               round(CASE WHEN a.d = b.d THEN 0.25 ELSE 0 END + CASE WHEN a.p = b.p THEN 0.2 ELSE 0 END + CASE WHEN a.i = b.i THEN 0.15 ELSE 0 END
                   + CASE WHEN a.f = b.f THEN 0.2 WHEN list_has_any(a.fn, b.fn) THEN 0.15 ELSE 0 END
                   + CASE WHEN a.l = b.l THEN 0.2 WHEN list_has_any(a.ln, b.ln) THEN 0.15 ELSE 0 END, 2)::DOUBLE AS score,
               round(1 - levenshtein(a.f, b.f) / greatest(length(a.f), length(b.f)), 4) AS first_similarity,
               round(1 - levenshtein(a.l, b.l) / greatest(length(a.l), length(b.l)), 4) AS last_similarity
        FROM near JOIN formed a ON a.record_id = x JOIN formed b ON b.record_id = y)"""
_PAIRS_SQL = f"""
    WITH {_SCORED_SQL},
    best AS (SELECT record_id, max(score) AS top FROM scored WHERE score >= 0.7 GROUP BY record_id),
    found AS (SELECT s.record_id, min(match_id) AS match_id FROM scored s JOIN best b ON s.record_id = b.record_id AND s.score = b.top GROUP BY s.record_id)
    SELECT s.record_id, s.match_id, s.score, s.first_similarity, s.last_similarity,
           CASE WHEN s.score >= 0.85 THEN 'MERGE' ELSE 'REVIEW' END AS tier
    FROM scored s JOIN found f ON s.record_id = f.record_id AND s.match_id = f.match_id"""


@query("match_pairs", _PAIRS_SQL)
def match_pairs(t: Tables):
    return matching.match_links(_fields(t))


_CLUSTER_SQL = f"""
    WITH RECURSIVE {_SCORED_SQL},
    edges AS (SELECT record_id AS x, match_id AS y FROM scored WHERE score >= 0.85 UNION SELECT record_id, record_id FROM fields),
    reach(x, y) AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
    assigned AS (SELECT x AS record_id, 'UPMI-' || CASE WHEN min(y) < 100000000 THEN lpad(CAST(min(y) AS VARCHAR), 8, '0') ELSE CAST(min(y) AS VARCHAR) END AS global_patient_id
                 FROM reach GROUP BY x)
"""


@query("assign_global_id", _CLUSTER_SQL + "SELECT record_id, global_patient_id FROM assigned")
def assign_global_id(t: Tables):
    return matching.assign_global_ids(_fields(t))


@query("duplicate_rate", _CLUSTER_SQL + """
    SELECT count(*) AS records, count(DISTINCT global_patient_id) AS patients,
           round((count(*) - count(DISTINCT global_patient_id)) / count(*) * 100, 4) AS duplicate_rate_pct FROM assigned""")
def duplicate_rate(t: Tables):
    return matching.duplicate_rate(matching.assign_global_ids(_fields(t)))


@query("review_queue", _CLUSTER_SQL + """
    SELECT least(x.global_patient_id, y.global_patient_id) AS left_id, greatest(x.global_patient_id, y.global_patient_id) AS right_id,
           max(score) AS score, CAST(NULL AS VARCHAR) AS tie_id
    FROM scored s JOIN assigned x ON x.record_id = s.record_id JOIN assigned y ON y.record_id = s.match_id
    WHERE score >= 0.7 AND score < 0.85 AND x.global_patient_id <> y.global_patient_id GROUP BY 1, 2""")
def review_queue(t: Tables):
    return matching.review_queue(_fields(t))
