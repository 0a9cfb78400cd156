"""Session settings the engine expects, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State of stream deduplication and windows may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}

BYTES_PER_TASK = 128 * 1024 * 1024


def build_session(master: str | None = None, app: str = "carelake", **extra: str) -> SparkSession:
    """Session with the engine's settings; `extra` overrides them (dots as double underscores)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def fit_shuffle(spark: SparkSession, input_bytes: int, bytes_per_task: int = BYTES_PER_TASK) -> int:
    """Raise the number of shuffle partitions to what the input needs; it is never lowered.

    The default of 200 gives partitions no task can hold once inputs reach terabytes. Small results are
    coalesced again at run time.
    """
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-input_bytes // bytes_per_task)
    if needed > now:
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
        return needed
    return now


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Point `DataFrame.checkpoint()` at the folder the cluster names in `spark.checkpoint.dir`.

    A folder of our own is only taken in local mode; on a cluster a machine-local folder would be lost
    with its executor, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="carelake-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder
