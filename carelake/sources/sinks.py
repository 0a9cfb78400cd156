"""Table writes. A table that is rebuilt goes to a new version folder and is then published by one rename."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "_current.json"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def append_bronze(df: DataFrame, root: str, source: str, partition: str = "_load_date") -> str:
    """Append to the bronze table of a source, one folder per load date.

    Rows are gathered per date before the write, so a date gets few files; AQE splits a date that is too
    large for one task. New columns are allowed: readers merge the file schemas.
    """
    path = f"{root}/bronze/{source}"
    df.hint("rebalance", F.col(partition)).write.mode("append").partitionBy(partition).parquet(path)
    return path


def append_evolving(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of both; a column only one side has is NULL on the other."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def current_version(spark: SparkSession, path: str) -> int | None:
    """Published version of a table, None before the first."""
    fs, p, Path = _fs(spark, f"{path}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        size = fs.getFileStatus(p).getLen()
        data = bytes(stream.readNBytes(int(size)))
    finally:
        stream.close()
    return json.loads(data)["version"]


def replace_table(df: DataFrame, path: str, keep_schema: bool = False, partition_by: Sequence[str] = ()) -> int:
    """Write `df` as the next version of the table and publish it.

    Versioned dimensions are best partitioned by `is_current`, so that loads read closed history apart.

    The version being read is never touched, so `df` may be computed from it, and a failed write leaves the
    published version in place.
    """
    spark = df.sparkSession
    now = current_version(spark, path)
    if keep_schema and now is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in read_current(spark, path).schema.fields])
    version = 0 if now is None else now + 1
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/v={version:06d}")
    fs, target, Path = _fs(spark, f"{path}/{POINTER}")
    draft = Path(f"{path}/{POINTER}.{version}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps({"version": version}).encode()))
    finally:
        out.close()
    # A rename inside one folder is atomic; FileContext may replace the target in the same step.
    jvm = spark.sparkContext._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri() if target.toUri().getScheme() else fs.getUri(),
        spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(draft, target, options)
    return version


def read_current(spark: SparkSession, path: str) -> DataFrame:
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/v={version:06d}")


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
               mode: str = "append") -> None:
    """Append to (audit) or overwrite (staging) a database table."""
    df.write.format("jdbc").options(url=url, dbtable=table, **(properties or {})).mode(mode).save()


def stage_export(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Parquet export for a warehouse bulk load, one folder per table."""
    written = {}
    for name, df in tables.items():
        path = f"{folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        written[name] = path
    return written


def clustered(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows of a key together and in order inside their partition, for files that prune well."""
    columns = [F.col(k) for k in keys]
    spread = df.repartition(partitions, *columns) if partitions else df.repartition(*columns)
    return spread.sortWithinPartitions(*columns)


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, mode: str = "overwrite") -> None:
    """Catalog table bucketed by its join key: joins of tables with equal buckets need no shuffle."""
    df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def split_rejected(df: DataFrame, valid: str, reason: str) -> tuple[DataFrame, DataFrame]:
    """Valid rows without their flag, and rejected rows with a reason. NULL flags count as rejected."""
    ok = F.coalesce(F.col(valid), F.lit(False))
    return (
        df.filter(ok).drop(valid),
        df.filter(~ok).drop(valid).withColumn("rejection_reason", F.lit(reason)),
    )


def dead_letters(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rejected rows of all streams in one frame with their source."""
    out = None
    for source, df in frames.items():
        tagged = df.withColumn("source", F.lit(source))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
