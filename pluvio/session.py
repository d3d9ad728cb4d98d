"""Session settings and the shared work folder."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from pluvio.config import SHUFFLE_PARTITION_BYTES


def file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, from the file system's metadata."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def stored_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, files and time of the last change of a file or folder: other values mean other content."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    summary = files.getContentSummary(folder)
    return summary.getLength(), summary.getFileCount(), files.getFileStatus(folder).getModificationTime()


def configure(spark: SparkSession, input_bytes: int = 0, partition_bytes: int = SHUFFLE_PARTITION_BYTES) -> SparkSession:
    """Set the runtime options the models rely on; readings are wall-clock, so the zone is UTC.

    With ``input_bytes`` shuffles start with a partition per ``partition_bytes`` of that input, where the
    session's own number is lower; the adaptive planner merges small ones again.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Microsecond timestamps carry min/max statistics, so filters on load time skip row groups.
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    # Keys of facts are hexadecimal text, which snappy stores whole.
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    planned = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(input_bytes / partition_bytes)
    if wanted > planned:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark


def write_parquet(rows: DataFrame, path: str, partition: str | None = None, mode: str = "errorifexists") -> None:
    """Write a table. What the query shuffled is removed when it ends, not when the driver's memory happens to be collected: else a job of
    many writes holds the shuffled rows of all of them on disk. The setting counts for this write only, as a frame run twice would shuffle twice.
    """
    conf, clean = rows.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(clean, "false")
    conf.set(clean, "true")
    try:
        writer = rows.write.mode(mode)
        (writer.partitionBy(partition) if partition else writer).parquet(path)
    finally:
        conf.set(clean, before)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path for written tables.

    It lies under ``spark.checkpoint.dir``, the folder all executors share. Only a local
    session without that setting may fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="pluvio-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
