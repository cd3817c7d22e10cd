"""Session helpers: a local session for tests and the shared working folder for files."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    """Session for tests and the local bench; on a cluster the caller brings its own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors and fixes the rows for every later reader."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written as Parquet below the shared folder and read again: cuts the lineage, survives the loss of executors, and
    later readers take only the columns they need."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what ``staged`` wrote for these frames, once nothing that is still to run reads it."""
    for frame in frames:
        delete_path(frame.sparkSession, frame._staged_at)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a path below the shared folder, on whatever file system it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of the jobs inside go as soon as their query has ended, not when the driver collects garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


# Lines up to which a lookup table is sent to every executor.
MAX_BROADCAST_ROWS = 100_000


def checked_broadcast(lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Compute a narrow lookup table now and broadcast it only if it is small; otherwise the join shuffles,
    with adaptive skew handling."""
    done = cut_lineage(lookup)
    return F.broadcast(done) if done.count() <= max_rows else done
