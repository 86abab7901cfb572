"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from math import ceil

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A roster below this size is broadcast; beyond it the join shuffles.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.scheduler.mode": "FAIR",
    # Recording the Python line of every column call costs more than the calls.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# What one shuffle task should hold.
_TASK_BYTES = 256 * 1024**2


def shuffle_partitions(input_bytes: int, cores: int = 8) -> int:
    """Shuffle partitions for an input size: enough to fit memory, at least one per core.

    Erring high is cheap, since AQE joins small neighbours at run time; a
    partition that is too large spills and cannot be split again.
    """
    return max(cores, ceil(input_bytes / _TASK_BYTES))


def build_session(
    app: str = "convoy", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings above, sized for an input; ``extra`` wins over both."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {}
    if input_bytes is not None:
        sized["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    for key, value in {**SETTINGS, **sized, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Read from ``spark.checkpoint.dir``. Only a local session without the
    setting gets a folder of its own; on a cluster a machine-local folder
    would lose data with its machine, so that case is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    # Executors of a local cluster are processes of their own, like those of any other.
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="convoy-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage there."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
