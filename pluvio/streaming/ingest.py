"""Readings that arrive as files, merged by key into a partitioned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pluvio.sources.scans import read_if_present
from pluvio.sources.sinks import merge_latest, replace_from_staging, touched_partitions


def stream_ingest(
    spark: SparkSession, in_dir: str, target: str, checkpoint: str, schema: T.StructType, *,
    keys: Sequence[str] = ("location_id", "timestamp"), time: str = "timestamp",
    order: Sequence[str] = ("_extracted_at", "id"), max_files: int | None = None,
) -> DataFrame:
    """Process every file of ``in_dir`` not seen before, then stop; return the table.

    Each micro-batch keeps the newest row per key, so a replayed or late file is harmless and
    the table equals the batch dedup of all files. The table has a folder per day of ``time``
    and a batch rewrites only the days it holds. Table and checkpoint belong in shared storage.
    """
    stored = T.StructType([*schema.fields, T.StructField("day", T.DateType())])
    staged_schema = T.StructType([*stored.fields, T.StructField("_batch", T.LongType())])
    staging = f"{checkpoint.rstrip('/')}/staged-rows"
    cluster = list(keys)

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        staged = read_if_present(session, staging, staged_schema)
        # A batch whose staged rows are complete was cut short while replacing partitions: finish that.
        if staged is None or staged.filter(F.col("_batch") == batch_id).isEmpty():
            fresh = batch.dropna(subset=list(keys)).withColumn("day", F.to_date(time))
            table = read_if_present(session, target, stored)
            if table is None:
                table = session.createDataFrame([], stored)
            old = table.filter(F.col("day").isin(touched_partitions(fresh, "day")))
            merged = merge_latest(old, fresh, keys, order).withColumn("_batch", F.lit(batch_id).cast("long"))
            merged.write.mode("overwrite").parquet(staging)
            staged = session.read.schema(staged_schema).parquet(staging)
        replace_from_staging(staged.drop("_batch"), target, "day", cluster)

    files = spark.readStream.schema(schema)
    if max_files is not None:
        files = files.option("maxFilesPerTrigger", max_files)
    query = (
        files.parquet(in_dir)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    table = read_if_present(spark, target, stored)
    return (spark.createDataFrame([], stored) if table is None else table).select(schema.fieldNames())
