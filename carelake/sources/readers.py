"""Source scans. Files are read with explicit schemas and never listed on the driver one by one."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from carelake.functions.text import clean_header, snake_header
from carelake.operators.cdc import normalise_op
from carelake.sources import mappings, schemas


def read_csv(spark: SparkSession, path, schema: T.StructType | None = None, pattern: str | None = None,
             required: Sequence[str] = ()) -> DataFrame:
    """CSV files, each read by its own header: all columns as text, names free of byte-order marks and blanks.

    Files with the same header line are read together, and the parts are put together by column name; a column that a
    file lacks is NULL in its rows, and an error if it is one of `schema` or `required`. `_file` keeps the name of the
    file a row came from.
    """
    needed = [*(schema.names if schema is not None else ()), *required]
    parts = []
    for header, files in _by_header(spark, path, pattern):
        names = [clean_header(c) for c in next(csv.reader([header]))]
        fields = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
        rows = spark.read.option("header", True).option("encoding", "UTF-8").schema(fields).csv(files)
        named = rows.select(
            *[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)], F.col("_metadata.file_name").alias("_file"))
        parts.append(require_columns(named, needed))
    if not parts:
        empty = T.StructType([T.StructField(n, T.StringType()) for n in [*needed, "_file"]])
        return spark.createDataFrame([], empty)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _by_header(spark: SparkSession, path, pattern: str | None) -> list[tuple[str, list[str]]]:
    """Header lines of the folder with the files that start with them; files without a line are left out.

    The driver gets one row per file, which is what a scan's file listing holds there anyway.
    """
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    lines = reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"))
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    found: dict[str, list[str]] = {}
    for row in first.orderBy("file").toLocalIterator():
        found.setdefault(row["header"], []).append(row["file"])
    return list(found.items())


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Stop when the feed lacks a required column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df


def read_patients(spark: SparkSession, path) -> DataFrame:
    return mappings.map_columns(read_csv(spark, path, schemas.PATIENT_CSV), mappings.PATIENTS)


def read_labs(spark: SparkSession, folder) -> DataFrame:
    """All CSV files of the landing folder in one scan; optional columns may be absent."""
    raw = read_csv(spark, folder, pattern="*.csv", required=schemas.LAB_REQUIRED)
    return mappings.map_columns(raw, [*mappings.LABS, ("_file", "_src_filename", "string")], absent_as_null=True)


def read_claim_pages(spark: SparkSession, path) -> DataFrame:
    """Saved API responses, one document per page; one row per claim."""
    pages = spark.read.schema(schemas.CLAIMS_PAGE).option("multiLine", True).json(path)
    return mappings.map_columns(pages.select(F.inline("data")), mappings.CLAIMS)


def _json_documents(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """JSON files whose root is an array of documents."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_appointments(spark: SparkSession, path) -> DataFrame:
    return mappings.map_columns(_json_documents(spark, path, schemas.APPOINTMENT), mappings.APPOINTMENTS)


def read_telemetry(spark: SparkSession, path) -> DataFrame:
    return mappings.map_columns(_json_documents(spark, path, schemas.TELEMETRY), mappings.TELEMETRY)


def read_pharmacy_changes(spark: SparkSession, path) -> DataFrame:
    """Change files; `op` holds the operation in the event-feed form c / u / d."""
    rows = mappings.map_columns(_json_documents(spark, path, schemas.CDC_FILE), mappings.PHARMACY_CHANGES)
    return rows.withColumn("op", normalise_op(F.col("op_type")))


def read_roster(spark: SparkSession, path) -> DataFrame:
    """Weekly sheet exported as CSV: snake_case headers, rows left over from merged headers removed."""
    raw = read_csv(spark, path)
    named = raw.toDF(*[c if c == "_file" else snake_header(c) for c in raw.columns])
    rows = named.filter(F.col("employee_id").isNotNull() & (F.lower(F.trim("employee_id")) != "employee id"))
    return mappings.map_columns(rows, [*mappings.ROSTER, ("_file", "_src_filename", "string")], absent_as_null=True)


def read_bronze(spark: SparkSession, root: str, source: str, load_date: str | None = None,
                merge_schema: bool = True) -> DataFrame:
    """Bronze parquet of a source; a load date prunes to its partition."""
    df = spark.read.option("mergeSchema", merge_schema).parquet(f"{root}/bronze/{source}")
    return df.filter(F.col("_load_date") == F.lit(load_date).cast("date")) if load_date else df


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table, or an empty one when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """Catalog table, or an empty one when it does not exist yet."""
    return spark.read.table(name) if spark.catalog.tableExists(name) else spark.createDataFrame([], schema)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, bounds: tuple | None = None, partitions: int = 1) -> DataFrame:
    """JDBC table; filters on the result are pushed down. Large tables take a partition column and bounds."""
    options: dict[str, object] = {"url": url, "dbtable": table, **(properties or {})}
    if partition_column:
        low, high = bounds
        options |= {"partitionColumn": partition_column, "lowerBound": low, "upperBound": high,
                    "numPartitions": partitions}
    return spark.read.format("jdbc").options(**options).load()


def with_lineage(df: DataFrame, source: str, run_id: str, loaded_at: Column, file: Column | None = None) -> DataFrame:
    """Lineage columns of the bronze layer. The load time is a parameter so that re-runs give the same rows."""
    at = loaded_at.cast("timestamp")
    return df.withColumns({
        "_source_system": F.lit(source),
        "_load_timestamp": at,
        "_load_date": at.cast("date"),
        "_input_file_name": F.lit(None).cast("string") if file is None else file,
        "_run_id": F.lit(run_id),
    })
