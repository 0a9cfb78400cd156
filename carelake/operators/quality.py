"""Data-quality checks. Every check yields finding rows; `gate` turns findings into a verdict."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions.checkdigits import luhn_valid, verhoeff_valid
from carelake.functions.privacy import FORBIDDEN_COLUMNS, VALUE_PATTERNS, holds_pattern

SEVERITY_RANK = {"INFO": 1, "WARNING": 2, "CRITICAL": 3}


def _unpivot(totals: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """Turn one wide aggregate row into one row per entry."""
    entries = [F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows]
    return totals.select(F.inline(F.array(*entries)))


def null_rates(df: DataFrame, limits: Mapping[str, float], any_of: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Null rate per column against its limit in percent, all columns in one scan.

    `any_of` adds named groups that count a row when any of their columns is NULL.
    """
    groups = {c: [c] for c in limits} | dict(any_of or {})
    limit_of = dict(limits)
    tests = {name: reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]) for name, cols in groups.items()}
    totals = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(test).alias(f"_n{i}") for i, test in enumerate(tests.values())],
    )
    rows = []
    for i, name in enumerate(tests):
        rate = F.coalesce(F.try_divide(F.col(f"_n{i}"), F.col("_total")) * 100, F.lit(0.0))
        rows.append([F.lit(name), F.col("_total"), F.col(f"_n{i}"), F.round(rate, 2),
                     rate <= F.lit(float(limit_of.get(name, 5.0)))])
    return _unpivot(totals, rows, ["column_name", "total_records", "null_count", "null_rate_pct", "passed"])


def apply_rules(tables: Mapping[str, DataFrame], rules: Sequence[Mapping[str, str]], strict: bool = False) -> DataFrame:
    """Rules `{table, column, rule_name, condition, severity}`: one scan per table for all its rules.

    A rule counts rows where NOT condition holds; with `strict` an unknown outcome fails too.
    """
    findings = []
    for table, df in tables.items():
        own = [r for r in rules if r["table"] == table]
        if not own:
            continue
        totals = df.agg(*[
            F.count_if(
                ~F.coalesce(F.expr(r["condition"]), F.lit(False)) if strict else ~F.expr(r["condition"])
            ).alias(f"_n{i}") for i, r in enumerate(own)
        ])
        rows = [[F.lit(table), F.lit(r["column"]), F.lit(r["rule_name"]), F.lit(r["severity"]), F.col(f"_n{i}"),
                 F.col(f"_n{i}") == 0] for i, r in enumerate(own)]
        findings.append(_unpivot(totals, rows, ["table_name", "column_name", "rule_name", "severity",
                                                "failed_count", "passed"]))
    return reduce(DataFrame.unionByName, findings)


def key_duplicates(df: DataFrame, keys: Sequence[str], limit_pct: float = 0.1) -> DataFrame:
    """Keys, duplicated keys, surplus rows and the surplus share against its limit."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rate = F.coalesce(F.try_divide(F.col("surplus_rows"), F.col("total_rows")) * 100, F.lit(0.0))
    return (
        counts.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus_rows"),
        )
        .withColumn("duplicate_rate_pct", F.round(rate, 4))
        .withColumn("passed", rate <= limit_pct)
    )


def multiple_current(dim: DataFrame, key: str) -> DataFrame:
    """Keys of a versioned dimension with other than one current row."""
    return (
        dim.groupBy(key).agg(F.count_if(F.col("is_current") == 1).alias("current_rows"))
        .filter(F.col("current_rows") != 1)
    )


def freshness(df: DataFrame, column: str, as_of: Column, hours: int = 24, by: Sequence[str] = ()) -> DataFrame:
    """Newest value per group and whether it is at most `hours` old."""
    newest = df.groupBy(*by).agg(F.max(column).alias("newest")) if by else df.agg(F.max(column).alias("newest"))
    fresh = F.col("newest") >= as_of - F.make_dt_interval(F.lit(0), F.lit(hours))
    return newest.withColumn("is_fresh", F.coalesce(fresh, F.lit(False)))


def count_ratio(counts: DataFrame, left: str, right: str, limit: float = 1.5) -> DataFrame:
    """Compare two count columns: difference, ratio, equality and the ratio limit."""
    ratio = F.try_divide(F.col(left), F.col(right))
    return counts.withColumns({
        "difference": F.col(left) - F.col(right),
        "count_ratio": F.round(ratio, 4),
        "reconciled": F.col(left) == F.col(right),
        "ratio_breach": F.coalesce(ratio > limit, F.lit(False)),
    })


def missing_columns(df: DataFrame, required: Sequence[str], table: str) -> DataFrame:
    """CRITICAL finding per required column the frame does not have."""
    have = {c.lower() for c in df.columns}
    lost = [c for c in required if c.lower() not in have]
    return df.sparkSession.createDataFrame(
        [(table, c, "required_column", "CRITICAL", f"column {c} is missing") for c in lost],
        "table_name string, column_name string, rule_name string, severity string, message string")


def schema_drift(df: DataFrame, registered: T.StructType, table: str) -> DataFrame:
    """WARNING finding per added, removed or retyped column."""
    now = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    then = {f.name: f.dataType.simpleString() for f in registered.fields}
    found = (
        [(c, f"added as {now[c]}") for c in now if c not in then]
        + [(c, "removed") for c in then if c not in now]
        + [(c, f"type {then[c]} became {now[c]}") for c in now if c in then and now[c] != then[c]]
    )
    return df.sparkSession.createDataFrame(
        [(table, c, "schema_drift", "WARNING", text) for c, text in found],
        "table_name string, column_name string, rule_name string, severity string, message string")


def _paths(kind: T.DataType, at: str = "") -> dict[str, str]:
    """Type of every field of a schema by its path; what is inside a list is under `[]`."""
    if isinstance(kind, T.StructType):
        return {p: t for f in kind.fields for p, t in _paths(f.dataType, f"{at}.{f.name}" if at else f.name).items()} or {at: "struct<>"}
    if isinstance(kind, T.ArrayType):
        return _paths(kind.elementType, f"{at}[]")
    return {at: kind.simpleString()}


def payload_drift(df: DataFrame, payload: str, registered: T.StructType, by: str) -> DataFrame:
    """WARNING finding per field of the JSON payloads that is new, lost or of another type than registered, by group.

    One aggregate merges the schemas of all payloads of a group (`schema_of_variant_agg`); what reaches the driver is one
    schema per group. A field counts as lost if no payload of the group has it with a value, and as of another type if its values
    do not share the registered one: whole numbers are bigint, other numbers decimal or double, a field of several types is
    variant. Payloads that are no JSON are a finding with their number. NULL payloads count for nothing.
    """
    parsed = df.where(F.col(payload).isNotNull()).select(F.col(by).cast("string").alias("member"), F.try_parse_json(payload).alias("v"))
    merged = parsed.groupBy("member").agg(
        F.schema_of_variant_agg("v").alias("found"), F.count("v").alias("good"), F.count_if(F.col("v").isNull()).alias("unreadable"))
    then = _paths(registered)
    rows = []
    for r in merged.collect():
        now = _paths(T.DataType.fromDDL(r["found"].replace("OBJECT<", "STRUCT<"))) if r["good"] else {}
        now = {p: t for p, t in now.items() if p and t != "void"}
        rows += [(r["member"], p, f"added as {t}") for p, t in now.items() if p not in then]
        if r["good"]:
            rows += [(r["member"], p, "removed") for p in then if p not in now]
        rows += [(r["member"], p, f"type {then[p]} became {t}") for p, t in now.items() if p in then and then[p] != t]
        if r["unreadable"]:
            rows.append((r["member"], None, f"{r['unreadable']} payloads are no JSON"))
    return df.sparkSession.createDataFrame(
        [(m, c, "payload_drift", "WARNING", text) for m, c, text in rows],
        "member string, column_name string, rule_name string, severity string, message string")


def forbidden_columns(df: DataFrame, table: str, exact: Sequence[str] = tuple(FORBIDDEN_COLUMNS),
                      parts: Sequence[str] = ("aadhaar", "phone", "email")) -> DataFrame:
    """CRITICAL finding per column name that must not be in the reporting layer; hashed forms are allowed."""
    bad = [c for c in df.columns
           if c.lower() in exact or (any(p in c.lower() for p in parts) and not c.lower().endswith("_hash"))]
    return df.sparkSession.createDataFrame(
        [(table, c, "personal_data_column", "CRITICAL", f"column {c} must not be published") for c in bad],
        "table_name string, column_name string, rule_name string, severity string, message string")


def value_scan(df: DataFrame, table: str, columns: Sequence[str] | None = None,
               patterns: Mapping[str, str] = VALUE_PATTERNS) -> DataFrame:
    """Rows per text column and pattern that hold personal data; one scan for all of them."""
    texts = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    pairs = [(c, p) for c in texts for p in patterns]
    totals = df.agg(*[F.count_if(holds_pattern(F.col(c), p, patterns[p])).alias(f"_n{i}") for i, (c, p) in enumerate(pairs)])
    rows = [[F.lit(table), F.lit(c), F.lit(p), F.col(f"_n{i}")] for i, (c, p) in enumerate(pairs)]
    return _unpivot(totals, rows, ["table_name", "column_name", "pattern", "hits"])


#: Patterns whose matches are numbers with a check digit.
CHECKED_PATTERNS = {
    "identifier_12": (VALUE_PATTERNS["identifier_12"], verhoeff_valid),
    "card": (r"\b[0-9](?:[ -]?[0-9]){12,18}\b", luhn_valid),
}


def checked_scan(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows per text column with a number that looks like personal data (`hits`), and with one whose check digit is right,
    too (`valid_hits`); one scan. Matches are only taken out of texts that have any."""
    pairs = [(c, p) for c in columns for p in CHECKED_PATTERNS]
    measures, rows = [], []
    for i, (c, p) in enumerate(pairs):
        pattern, valid = CHECKED_PATTERNS[p]
        looks = F.col(c).rlike(pattern)
        right = F.exists(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), valid)
        measures += [F.count_if(looks).alias(f"_n{i}"), F.count_if(F.when(looks, right)).alias(f"_v{i}")]
        rows.append([F.lit(table), F.lit(c), F.lit(p), F.col(f"_n{i}"), F.col(f"_v{i}")])
    return _unpivot(df.agg(*measures), rows, ["table_name", "column_name", "pattern", "hits", "valid_hits"])


def gate(findings: DataFrame) -> DataFrame:
    """Verdict over failed findings `(severity, message)`: the worst severity and the first five issues."""
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in SEVERITY_RANK.items() for x in kv]), F.col("severity"))
    names = F.create_map(*[F.lit(x) for k, v in SEVERITY_RANK.items() for x in (v, k)])
    ranked = findings.select(rank.alias("_rank"), "message")
    order = F.struct((-F.col("_rank")).alias("r"), F.col("message").alias("m"))
    first = ranked.orderBy(F.desc("_rank"), "message").limit(5).agg(
        F.concat_ws("; ", F.transform(F.array_sort(F.collect_list(order)), lambda x: x["m"])))
    worst = ranked.agg(F.count(F.lit(1)).alias("issues"), F.coalesce(F.max("_rank"), F.lit(0)).alias("_worst"))
    return worst.select(
        F.when(F.col("_worst") >= SEVERITY_RANK["CRITICAL"], "HALT").otherwise("PASS").alias("verdict"),
        F.coalesce(F.try_element_at(names, F.col("_worst")), F.lit("NONE")).alias("worst_severity"),
        "issues", first.scalar().alias("first_issues"))


class GateHalted(RuntimeError):
    """Raised when critical findings stop a run."""


def enforce(findings: DataFrame) -> None:
    """Stop the run when the gate says HALT."""
    verdict = gate(findings).first()
    if verdict["verdict"] == "HALT":
        raise GateHalted(verdict["first_issues"])


def row_count_drops(df: DataFrame, by: Sequence[str], day: str, limit_pct: float = 20.0) -> DataFrame:
    """Days whose row count fell by more than the limit against the previous day present."""
    daily = df.groupBy(*by, day).agg(F.count(F.lit(1)).alias("row_count"))
    along = Window.partitionBy(*by).orderBy(day)
    fall = F.try_divide(F.col("previous_count") - F.col("row_count"), F.col("previous_count")) * 100
    return (
        daily.withColumn("previous_count", F.lag("row_count").over(along))
        .filter(fall > limit_pct)
        .withColumn("drop_pct", F.round(fall, 2))
    )


def required_payload_fields(df: DataFrame, payload: str, fields: Sequence[str], by: Sequence[str]) -> DataFrame:
    """JSON payloads that lack a required field, per group; the text is parsed once per row."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    parsed = df.withColumn("_p", F.from_json(F.col(payload), schema))
    return parsed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("payloads"),
        *[F.count_if(F.col(f"_p.{f}").isNull()).alias(f"missing_{f}") for f in fields])
