"""Erasure of subjects from stored tables: only partitions that hold them are rewritten, and their absence is proved.

For tables in folders of Parquet files, partitioned or not. The files of a subject are found by one scan of the key column
with the name of each row's file; partitions without such a file are never opened again.
"""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators.joins import settled

MANIFEST_SCHEMA = ("run_id string, table_name string, partition string, files long, rows_before long, rows_erased long, "
                   "rows_left long, verified boolean")
_TYPED = "spark.sql.sources.partitionColumnTypeInference.enabled"


def _read(spark: SparkSession, root: str, folders: list[str] | None = None) -> DataFrame:
    """The table, or some of its partitions; partition values stay text, so that they are written as they were."""
    before = spark.conf.get(_TYPED)
    spark.conf.set(_TYPED, "false")
    try:
        return spark.read.option("mergeSchema", "true").option("basePath", root).parquet(*(folders or [root]))
    finally:
        spark.conf.set(_TYPED, before)


_NULL = "__HIVE_DEFAULT_PARTITION__"


def _partitions(folder: str, root: str) -> list[tuple[str, str | None]]:
    """Column and value of each partition level between the root and the folder."""
    levels = [level.split("=", 1) for level in _below(folder, root).strip("/").split("/") if "=" in level]
    return [(column, None if value == _NULL else unquote(value)) for column, value in levels]


def erase_stored(spark: SparkSession, tables: Mapping[str, tuple[str, str]], subjects: DataFrame, run_id: str) -> DataFrame:
    """Remove the subjects (one column, their ids) from every table `{name: (folder, key)}`; one manifest row per touched
    partition. `verified` says that a scan of the rewritten partition has found no subject any more.

    Survivors are written aside first, then each touched partition is replaced; a run that failed is run again. Name every layer
    that holds the subjects, change logs and dead letters included.
    """
    ids = subjects.select(F.col(subjects.columns[0]).alias("_subject")).where("_subject IS NOT NULL").distinct()
    rows = []
    for name, (root, key) in tables.items():
        rows += _erase_one(spark, name, root, key, ids, run_id)
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def _holding(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Per folder: files and rows that hold a subject. Left out are folders without."""
    named = df.select(F.col(key).alias("_subject"), F.col("_metadata.file_path").alias("file"))
    marked = named.join(ids.withColumn("_hit", F.lit(True)), "_subject", "left")
    return marked.groupBy(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).agg(
        F.count_distinct(F.when(F.col("_hit"), F.col("file"))).alias("files"), F.count(F.lit(1)).alias("rows"),
        F.count("_hit").alias("hits")).where("hits > 0")


def _erase_one(spark: SparkSession, name: str, root: str, key: str, ids: DataFrame, run_id: str) -> list[tuple]:
    # One row per partition of the table that holds a subject.
    found = {unquote(r["folder"]): r for r in _holding(_read(spark, root), key, ids).collect()}
    if not found:
        return []
    folders = sorted(found)
    levels = [column for column, _ in _partitions(folders[0], root)]
    touched = _read(spark, root, folders if levels else None)
    kept = settled(touched.join(ids, touched[key] == ids["_subject"], "left_anti"))
    if levels:
        kept.hint("rebalance", *map(F.col, levels)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*levels).parquet(root)
    else:
        kept.write.mode("overwrite").parquet(root)
    left = {tuple(r[:-1]): r[-1] for r in kept.groupBy(*levels).agg(F.count(F.lit(1))).collect()}
    out = []
    for folder in folders:
        values = tuple(value for _, value in _partitions(folder, root))
        if levels and values not in left:  # nobody is left: an empty file takes the place of the others
            kept.limit(0).drop(*levels).coalesce(1).write.mode("overwrite").parquet(folder)
        out.append((folder, values))
    still = {unquote(r["folder"]) for r in _holding(_read(spark, root, folders if levels else None), key, ids).collect()}
    return [(run_id, name, "/".join(f"{c}={v}" for c, v in zip(levels, values)), found[f]["files"], found[f]["rows"],
             found[f]["hits"], left.get(values, 0), f not in still) for f, values in out]


def _below(folder: str, root: str) -> str:
    """The part of a folder's path below the root, whatever scheme either is written with."""
    plain = lambda p: "/" + p.split("://", 1)[-1].split(":", 1)[-1].strip("/") + "/"
    return plain(folder).split(plain(root), 1)[-1]
