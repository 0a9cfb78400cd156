"""The given tables read as domain tables: Spark readers and the same definitions as SQL views."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators.joins import plan_bytes
from carelake.session import fit_shuffle

EVENTS_AS_OF = "2024-01-31"
ORDERS_AS_OF = "2001-12-31"

HOSPITALS = ["CHN", "MDU", "CBE", "TRV"]


def hospital_of(key: str) -> Column:
    return F.element_at(F.array(*[F.lit(h) for h in HOSPITALS]), (F.col(key) % 4 + 1).cast("int"))


def hospital_sql(key: str) -> str:
    return f"CASE {key} % 4 WHEN 0 THEN 'CHN' WHEN 1 THEN 'MDU' WHEN 2 THEN 'CBE' ELSE 'TRV' END"


def claim_id_of(order: str, line: str, drug: str, physician: str, day: str) -> Column:
    return F.concat_ws("-", order, line, drug, physician, F.col(day).cast("string"))


def minutes(count: Column) -> Column:
    zero = F.lit(0)
    return F.make_dt_interval(zero, zero, count.cast("int"))


def seconds(count: Column) -> Column:
    zero = F.lit(0)
    return F.make_dt_interval(zero, zero, zero, count.cast("decimal(18,6)"))


def midnight(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")


STATUS = {"A": "APPROVED", "R": "DENIED", "N": "PENDING"}
OPS = {"signup": "c", "error": "d"}
TESTS = {"signup": "POTASSIUM", "error": "TROPONIN", "click": "HEMOGLOBIN", "view": "PT_INR", "purchase": "GLUCOSE"}


def _lookup(codes: dict[str, str], key: str, default: str | None = None) -> Column:
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]), F.col(key))
    return found if default is None else F.coalesce(found, F.lit(default))


class Tables:
    """Lazy readers over one data folder. Every reader is a projection, so scans stay pruned."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            fit_shuffle(self.spark, sum(plan_bytes(df) for df in self._opened.values()))
        return self._opened[name]

    @cached_property
    def patients(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.raw("customer").join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
            key.alias("patient_id"),
            F.concat(F.lit("HIS-CHN-"), key).alias("global_patient_id"),
            F.upper(F.trim("c_name")).alias("full_name"),
            F.concat(F.lit("98"), F.lpad(key.cast("string"), 8, "0")).alias("phone_number"),
            F.concat(F.lit("user"), key, F.lit("@example.com")).alias("email"),
            (key + 512345678900).cast("string").alias("aadhaar_number"),
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("insurance_plan_id"),
            F.col("c_acctbal").alias("balance"),
        )

    @cached_property
    def admissions(self) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        return self.raw("orders").select(
            F.col("o_orderkey").alias("admission_id"),
            F.col("o_custkey").alias("patient_id"),
            hospital_of("o_orderkey").alias("hospital_code"),
            day.alias("admission_date"),
            F.when(F.col("o_orderstatus") != "O", F.date_add(day, (F.col("o_orderkey") % 10).cast("int"))).alias("discharge_date"),
            F.col("o_orderpriority").alias("dept_code"),
        )

    def claims(self, patient: bool = False, diagnosis: bool = False, short_id: bool = False) -> DataFrame:
        """Claims; the joins to patients and diagnoses are made only when their columns are asked for.

        With `short_id` the claim_id holds only what no other column does; `with_claim_id` makes the whole id of it.
        """
        amount = F.col("l_extendedprice").cast("decimal(12,2)")
        status = _lookup(STATUS, "l_returnflag")
        # before the joins, which move a day and an amount in fewer bytes than what they are read from
        df = self.raw("lineitem").withColumns({"claim_date": F.col("l_shipdate").cast("date"), "claim_amount": amount})
        net = (F.col("claim_amount") * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(12,2)")
        extra = []
        if patient:
            df = df.join(self.raw("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            day = F.col("o_orderdate").cast("date")
            left = F.when(F.col("o_orderstatus") != "O", F.date_add(day, (F.col("o_orderkey") % 10).cast("int")))
            extra += [
                F.col("o_custkey").alias("patient_id"),
                (F.coalesce(left, day).cast("timestamp_ntz") + minutes(F.col("l_linenumber") * 20)).alias("submission_ts"),
            ]
        if diagnosis:
            df = df.join(self.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
            extra.append(F.col("p_type").alias("diagnosis_code"))
        return df.select(
            (F.struct("l_linenumber") if short_id else claim_id_of(
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "claim_date")).alias("claim_id"),
            F.col("l_orderkey").alias("admission_id"),
            F.col("l_suppkey").alias("physician_id"),
            hospital_of("l_orderkey").alias("hospital_code"),
            (F.col("l_partkey") % 5).cast("int").alias("procedure_code"),
            F.concat(F.lit("PAYER-"), "l_linestatus").alias("payer_code"),
            "claim_date",
            "claim_amount",
            F.when(status == "APPROVED", net).alias("approved_amount"),
            status.alias("status"),
            F.col("l_partkey").alias("drug_id"),
            F.col("l_quantity").alias("quantity"),
            *extra,
        )

    @staticmethod
    def with_claim_id(claims: DataFrame) -> DataFrame:
        return claims.withColumn("claim_id", claim_id_of(
            "admission_id", "claim_id.l_linenumber", "drug_id", "physician_id", "claim_date"))

    @cached_property
    def discharges(self) -> DataFrame:
        return self.admissions.filter(F.col("discharge_date").isNotNull()).select(
            "patient_id", F.col("discharge_date").cast("timestamp_ntz").alias("discharge_ts"))

    @cached_property
    def vitals(self) -> DataFrame:
        event = F.col("event_id")
        return self.raw("events").select(
            "event_id",
            F.col("user_id").alias("device_id"),
            F.when(event % 211 != 0, F.concat(F.lit("MRN-"), "user_id")).alias("patient_mrn"),
            hospital_of("user_id").alias("hospital_code"),
            F.col("ts").alias("event_ts"),
            F.when(event % 97 != 0, F.floor(F.lit(40) + F.col("value") / 2).cast("int")).alias("heart_rate"),
            (F.lit(100) - event % 15).cast("double").alias("spo2"),
            (F.lit(100) + event % 85).cast("int").alias("systolic_bp"),
            (F.lit(36.0) + (event % 40) / F.lit(10.0)).alias("temperature_c"),
        )

    @cached_property
    def changes(self) -> DataFrame:
        return self.raw("events").select(
            F.col("user_id").alias("inventory_id"),
            _lookup(OPS, "event_type", "u").alias("op"),
            F.col("ts").alias("ts_ms"),
            F.col("event_id").alias("offset"),
            F.col("value").alias("quantity"),
            F.col("props").alias("payload"),
        )

    @cached_property
    def labs(self) -> DataFrame:
        tat = F.round(F.col("value") * 60).cast("long")
        released = F.col("ts") + seconds(tat)
        return self.raw("events").select(
            F.col("event_id").alias("order_id"),
            hospital_of("user_id").alias("hospital_code"),
            F.concat(F.lit("D"), F.col("user_id") % 5).alias("dept_code"),
            F.when(F.col("event_id") % 3 == 0, "STAT").otherwise("ROUTINE").alias("order_type"),
            _lookup(TESTS, "event_type").alias("test_code"),
            F.col("ts").alias("collected_ts"),
            released.alias("released_ts"),
            (released + minutes(F.col("event_id") % 30)).alias("flagged_ts"),
            (F.col("value") / F.lit(50.0)).alias("result_value"),
            tat.alias("tat_seconds"),
        )

    @cached_property
    def drugs(self) -> DataFrame:
        key = F.col("p_partkey")
        price = F.col("p_retailprice").cast("decimal(10,2)")
        return self.raw("part").select(
            key.alias("drug_id"), F.col("p_name").alias("drug_name"), price.alias("price"),
            (F.col("p_size") * 10).alias("current_stock"),
            F.date_add(F.lit("2024-01-01").cast("date"), (key % 90).cast("int")).alias("expiry_date"),
            (price * (F.col("p_size") * 10).cast("decimal(10,0)")).cast("decimal(18,2)").alias("stock_value"),
        )

    @cached_property
    def site_stock(self) -> DataFrame:
        """Stock per drug and hospital."""
        sites = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(h).alias("hospital_code")) for i, h in enumerate(HOSPITALS)])
        return self.raw("part").select("p_partkey", F.inline(sites)).select(
            F.col("p_partkey").alias("drug_id"), "hospital_code",
            ((F.col("p_partkey") * 7 + F.col("i") * 13) % 200).alias("current_stock"))

    @cached_property
    def runs(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderpriority").alias("pipeline_name"),
            F.col("o_orderkey").alias("run_id"),
            F.col("o_orderdate").cast("date").alias("run_date"),
            F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS").alias("status"),
            F.floor(F.col("o_totalprice") / 100).cast("long").alias("duration_seconds"),
        )

    @cached_property
    def registrations(self) -> DataFrame:
        """Patient registrations; indebted and wealthy customers are registered a second time with a
        truncated last name, the wealthy ones also under another identifier."""
        key = F.col("c_custkey")
        base = self.raw("customer").select(
            key.alias("record_id"),
            F.translate(key.cast("string"), "0123456789", "BCDFGHJKLM").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
            F.date_add(F.lit("1940-01-01").cast("date"), (key * 37 % 25000).cast("int")).alias("birth_date"),
            F.concat(F.lit("98"), F.lpad(key.cast("string"), 8, "0")).alias("phone"),
            F.sha2((key + 512345678900).cast("string"), 256).alias("id_hash"),
            F.col("c_acctbal").alias("balance"),
        )
        again = base.filter((F.col("balance") < 0) | (F.col("balance") > 9000)).withColumns({
            "last_name": F.expr("left(last_name, length(last_name) - 1)"),
            "id_hash": F.when(F.col("balance") > 9000, F.sha2(F.col("record_id").cast("string"), 256)).otherwise(F.col("id_hash")),
            "record_id": F.col("record_id") + 1000000000,
        })
        return base.unionByName(again).drop("balance")


_DISCHARGE = "CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER) END"
_AMOUNT = "CAST(l_extendedprice AS DECIMAL(12,2))"
_CLAIM_STATUS = "CASE l_returnflag WHEN 'A' THEN 'APPROVED' WHEN 'R' THEN 'DENIED' WHEN 'N' THEN 'PENDING' END"

VIEWS = {
    "patients": """
        SELECT c_custkey AS patient_id, 'HIS-CHN-' || c_custkey AS global_patient_id,
               upper(trim(c_name)) AS full_name, '98' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone_number,
               'user' || c_custkey || '@example.com' AS email,
               CAST(c_custkey + 512345678900 AS VARCHAR) AS aadhaar_number, n_name AS city,
               c_mktsegment AS insurance_plan_id, c_acctbal AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "admissions": f"""
        SELECT o_orderkey AS admission_id, o_custkey AS patient_id, {hospital_sql('o_orderkey')} AS hospital_code,
               CAST(o_orderdate AS DATE) AS admission_date, CAST({_DISCHARGE} AS DATE) AS discharge_date,
               o_orderpriority AS dept_code
        FROM orders""",
    "claims": f"""
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS claim_id,
               l_orderkey AS admission_id, l_suppkey AS physician_id, {hospital_sql('l_orderkey')} AS hospital_code,
               CAST(l_partkey % 5 AS INTEGER) AS procedure_code, 'PAYER-' || l_linestatus AS payer_code,
               CAST(l_shipdate AS DATE) AS claim_date, {_AMOUNT} AS claim_amount,
               CASE WHEN l_returnflag = 'A' THEN CAST({_AMOUNT} * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2)) END AS approved_amount,
               {_CLAIM_STATUS} AS status, l_partkey AS drug_id, l_quantity AS quantity, o_custkey AS patient_id,
               CAST(coalesce({_DISCHARGE}, CAST(o_orderdate AS DATE)) AS TIMESTAMP) + to_minutes(l_linenumber * 20) AS submission_ts,
               p_type AS diagnosis_code
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "vitals": f"""
        SELECT event_id, user_id AS device_id, CASE WHEN event_id % 211 <> 0 THEN 'MRN-' || user_id END AS patient_mrn,
               {hospital_sql('user_id')} AS hospital_code, ts AS event_ts,
               CASE WHEN event_id % 97 <> 0 THEN CAST(floor(40 + value / 2) AS INTEGER) END AS heart_rate,
               CAST(100 - event_id % 15 AS DOUBLE) AS spo2, CAST(100 + event_id % 85 AS INTEGER) AS systolic_bp,
               CAST(36.0 AS DOUBLE) + (event_id % 40) / CAST(10.0 AS DOUBLE) AS temperature_c
        FROM events""",
    "graded": """
        SELECT *, CASE WHEN heart_rate < 45 OR heart_rate > 130 OR spo2 < 90 OR systolic_bp > 180 OR temperature_c > 39.5 THEN 'CRITICAL'
                       WHEN heart_rate < 55 OR heart_rate > 110 OR spo2 < 94 OR systolic_bp > 160 THEN 'WARNING'
                       ELSE 'NORMAL' END AS alert_level,
               coalesce(heart_rate BETWEEN 20 AND 300 AND spo2 BETWEEN 70 AND 100 AND systolic_bp BETWEEN 50 AND 250
                        AND patient_mrn IS NOT NULL AND device_id IS NOT NULL, false) AS dq_passed
        FROM vitals""",
    "changes": """
        SELECT user_id AS inventory_id, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
               ts AS ts_ms, event_id AS "offset", value AS quantity, props AS payload
        FROM events""",
    "labs": f"""
        SELECT event_id AS order_id, {hospital_sql('user_id')} AS hospital_code, 'D' || (user_id % 5) AS dept_code,
               CASE WHEN event_id % 3 = 0 THEN 'STAT' ELSE 'ROUTINE' END AS order_type,
               CASE event_type WHEN 'signup' THEN 'POTASSIUM' WHEN 'error' THEN 'TROPONIN' WHEN 'click' THEN 'HEMOGLOBIN'
                    WHEN 'view' THEN 'PT_INR' WHEN 'purchase' THEN 'GLUCOSE' END AS test_code,
               ts AS collected_ts, ts + to_seconds(CAST(round(value * 60) AS BIGINT)) AS released_ts,
               ts + to_seconds(CAST(round(value * 60) AS BIGINT)) + to_minutes(CAST(event_id % 30 AS BIGINT)) AS flagged_ts,
               value / CAST(50.0 AS DOUBLE) AS result_value, CAST(round(value * 60) AS BIGINT) AS tat_seconds
        FROM events""",
    "drugs": """
        SELECT p_partkey AS drug_id, p_name AS drug_name, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
               p_size * 10 AS current_stock, CAST(DATE '2024-01-01' + CAST(p_partkey % 90 AS INTEGER) AS DATE) AS expiry_date,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) * (p_size * 10) AS DECIMAL(18,2)) AS stock_value
        FROM part""",
    "site_stock": """
        SELECT p_partkey AS drug_id, hospital_code, (p_partkey * 7 + i * 13) % 200 AS current_stock
        FROM part, (VALUES (0, 'CHN'), (1, 'MDU'), (2, 'CBE'), (3, 'TRV')) AS site(i, hospital_code)""",
    "runs": """
        SELECT o_orderpriority AS pipeline_name, o_orderkey AS run_id, CAST(o_orderdate AS DATE) AS run_date,
               CASE WHEN o_orderstatus = 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CAST(floor(o_totalprice / 100) AS BIGINT) AS duration_seconds
        FROM orders""",
    "registrations": """
        WITH base AS (
            SELECT c_custkey AS record_id, translate(CAST(c_custkey AS VARCHAR), '0123456789', 'BCDFGHJKLM') AS first_name,
                   c_mktsegment AS last_name, CAST(DATE '1940-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER) AS DATE) AS birth_date,
                   '98' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone,
                   sha256(CAST(c_custkey + 512345678900 AS VARCHAR)) AS id_hash, c_acctbal AS balance
            FROM customer)
        SELECT record_id, first_name, last_name, birth_date, phone, id_hash FROM base
        UNION ALL
        SELECT record_id + 1000000000, first_name, left(last_name, length(last_name) - 1), birth_date, phone,
               CASE WHEN balance > 9000 THEN sha256(CAST(record_id AS VARCHAR)) ELSE id_hash END
        FROM base WHERE balance < 0 OR balance > 9000""",
    "flagged_admissions": """
        SELECT *, CASE WHEN days_since_discharge BETWEEN 0 AND 30 THEN 1 ELSE 0 END AS is_readmission
        FROM (SELECT *, CAST(admission_date - prev_discharge AS INTEGER) AS days_since_discharge
              FROM (SELECT *, lag(discharge_date) OVER (PARTITION BY patient_id ORDER BY admission_date, admission_id) AS prev_discharge
                    FROM admissions))""",
    "versions": """
        WITH daily AS (
            SELECT o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS d, arg_max(o_orderpriority, o_orderkey) AS plan
            FROM orders GROUP BY ALL),
        marked AS (SELECT *, lag(plan) OVER (PARTITION BY patient_id ORDER BY d) AS before FROM daily)
        SELECT patient_id, plan, d AS eff_start_date, lead(d) OVER (PARTITION BY patient_id ORDER BY d) AS eff_end_date,
               sha256(plan) AS record_hash
        FROM marked WHERE before IS NULL OR before <> plan""",
}
