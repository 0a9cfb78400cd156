"""Shared helpers: scratch tables in the cluster's folder, sampling of labelled rows, connected components."""

from __future__ import annotations

import math
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.operators import components
from carelake.operators.joins import join_summary

#: A word: what stands between space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

#: The same characters as a separator.
GAP = r"[\x20\x09-\x0D]+"


class Scratch:
    """Tables between the steps of one operator, as Parquet in the folder `spark.checkpoint.dir` names.

    They are ordinary files all executors reach, so a lost executor costs no recomputation. A folder of our own is
    taken in local mode only. `drop` frees the space of a table that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.made: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("errorifexists").parquet(path)
        self.made[name] = df.schema
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Replace tables by empty ones."""
        for name in names:
            schema = self.made.pop(name)
            self.spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{name}")


def written_place(df: DataFrame, scratch: Scratch) -> DataFrame:
    """`df` with `place`, which sorts rows as they were written: number of the part file, file, row of the file.

    Readers deal files to tasks by size, so the order of a read table is not that of its partitions. A table that is
    not read from files is written first.
    """
    if df._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        df = scratch.keep(df, "rows")
    number = F.expr("try_cast(regexp_extract(_metadata.file_name, '^part-([0-9]+)', 1) AS bigint)")
    return df.withColumn("place", F.struct(
        number.alias("part"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="llm-")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Put this package on the executors, as an archive of its sources."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="llm-sources-")  # the driver serves the archive as long as it runs
        shutil.copytree(package, f"{folder}/src/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
        sc.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", f"{folder}/src"))
        _SHIPPED.add(sc.applicationId)


def arrow(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """`mapInArrow`, once this package is on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that no classifier learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sampled(df: DataFrame, group: str, key: Column, per_group: int) -> DataFrame:
    """About `per_group` rows of each group, the same ones in every run; all rows of a smaller group.

    The share to take comes from a count of all rows; a row is taken when its hash falls below that share.
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    place = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    share = F.least(F.lit(1.0), F.lit(float(per_group)) / F.col("_n"))
    return join_summary(df, counts, [group], "inner").where(place < share).drop("_n")


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """`node` and `component`, its smallest node; the tables of all rounds go to the scratch folder."""
    return components.connected_components(edges, lambda df, part: scratch.keep(df, f"{name}-{part}"))


def blocks(total: int, limit: int) -> Iterator[tuple[int, int]]:
    """(slice, number of slices) so that no slice of `total` units is far above `limit`."""
    n = max(1, math.ceil(total / limit))
    for i in range(n):
        yield i, n
