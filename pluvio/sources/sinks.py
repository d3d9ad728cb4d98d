"""Loads: append, upsert, window reload, truncate and the partitioned mart writes. ``versions`` has the stored upsert and reload."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from pluvio.config import BROADCAST_LIMIT_BYTES, ROWS_PER_FILE
from pluvio.operators.joins import measured_bytes
from pluvio.operators.staging import dedup_latest
from pluvio.session import file_system, write_parquet


def as_declared(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def append_load(df: DataFrame, path: str, schema: StructType) -> DataFrame:
    """Append a batch with the declared schema and return the whole table."""
    as_declared(df, schema).write.mode("append").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def truncate_reload(df: DataFrame, path: str, schema: StructType, truncate: bool = True) -> DataFrame:
    """Load into an emptied table; with ``truncate=False`` the old rows stay. ``df`` must not read ``path``."""
    as_declared(df, schema).write.mode("overwrite" if truncate else "append").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], keep: Sequence[str],
    order: Sequence[str] = ("_extracted_at", "id"), by: Sequence[Column] = (),
) -> DataFrame:
    """Insert or update by key.

    Of several batch rows with one key the last by ``order`` counts. An update replaces every
    column except those of ``keep``, which hold the target's values even when these are null.
    Both sides are unique by key at the join, so no key can be hot there.

    With ``by``, which must follow from the keys, both sides go by one exchange and the result lies together by it; repeats of a key
    in the batch are shuffled then.
    """
    if by:
        return _upsert_in_place(target, batch, keys, keep, order, by)
    last = dedup_latest(batch, keys, order)
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    b = last.withColumn("_in_batch", F.lit(True)).alias("b")
    joined = t.join(b, list(keys), "full_outer")

    def merged(name: str):
        if name in keys:
            return F.col(name)
        winner = "_in_target" if name in keep else "_in_batch"
        first, second = ("t", "b") if name in keep else ("b", "t")
        return F.when(F.col(winner), F.col(f"{first}.{name}")).otherwise(F.col(f"{second}.{name}")).alias(name)

    return joined.select([merged(name) for name in target.columns])


def _upsert_in_place(target: DataFrame, batch: DataFrame, keys: Sequence[str], keep: Sequence[str], order: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """``upsert`` by a window over the rows of both sides in place of a join."""
    places = {f"_by{k}": c for k, c in enumerate(by)}
    both = target.withColumn("_new", F.lit(False)).unionByName(batch.select(target.columns).withColumn("_new", F.lit(True)))
    both = both.withColumns(places).repartition(*places)
    # As in a join, a null is no other null's equal: such rows of the batch are apart from the target's.
    apart = F.col("_new") & reduce(or_, [F.col(k).isNull() for k in keys])
    # Of a key the batch's last row comes first, the target's rows last.
    group = Window.partitionBy(*places, *keys, apart).orderBy(F.desc("_new"), *[F.desc_nulls_last(c) for c in order])
    entire = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    updated = [c for c in target.columns if c not in keys and c not in keep]
    seen = both.withColumns({
        "_rank": F.row_number().over(group), "_in_batch": F.first("_new").over(group), "_in_target": ~F.last("_new").over(entire),
        **{f"_last{k}": F.first(c).over(group) for k, c in enumerate(updated)},
    }).filter(~F.col("_new") | (~F.col("_in_target") & (F.col("_rank") == 1)))
    last = {c: F.when(F.col("_in_batch"), F.col(f"_last{k}")).otherwise(F.col(c)) for k, c in enumerate(updated)}
    return seen.select([last[c].alias(c) if c in last else F.col(c) for c in target.columns])


def merge_latest(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                 order: Sequence[str] = ("_extracted_at", "id")) -> DataFrame:
    """Target and batch together, newest row per key. Merging a batch again changes nothing."""
    return dedup_latest(target.unionByName(batch), keys, order)


def reload_window(target: DataFrame, batch: DataFrame, start, end, column: str = "date",
                  unbounded: bool = False) -> DataFrame:
    """Drop the target's rows of ``[start, end]`` and add the batch; ``unbounded`` also drops all later rows."""
    c = F.col(column)
    outside = (c < F.lit(start)) | c.isNull()
    if not unbounded:
        outside = outside | (c > F.lit(end))
    return target.filter(outside).unionByName(batch)


def touched_partitions(batch: DataFrame, column: str) -> list:
    """Days of a batch: one per folder the write creates anyway."""
    return [row[0] for row in batch.select(column).distinct().collect()]


def replace_from_staging(staged: DataFrame, path: str, column: str, cluster: Sequence[str]) -> None:
    """Overwrite the partitions present in ``staged``."""
    clustered(staged, column, cluster).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        column
    ).parquet(path)


def folder_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values that have a folder of a partitioned table, as text."""
    files, folder = file_system(spark, path)
    return [name.split("=")[1] for name in (s.getPath().getName() for s in files.listStatus(folder)) if name.startswith(f"{column}=")]


def finish_replacing(spark: SparkSession, path: str, staging: str, column: str) -> None:
    """If ``staging`` is complete, its folders take the place of those under ``path``, and it goes.

    Folders are moved, not written again. One that has been moved is no longer in ``staging``, so a run cut short goes on where it was.
    """
    files, folder = file_system(spark, staging)
    if not files.exists(file_system(spark, f"{staging}/_SUCCESS")[1]):
        return
    files.mkdirs(file_system(spark, path)[1])
    for value in folder_values(spark, staging, column):
        old, new = (file_system(spark, f"{place}/{column}={value}")[1] for place in (path, staging))
        files.delete(old, True)
        if not files.rename(new, old):
            raise OSError(f"{new} could not be moved to {old}")
    files.delete(folder, True)


def replace_partitions(rows: DataFrame, path: str, staging: str, schema: StructType, column: str, cluster: Sequence[str]) -> None:
    """Overwrite the partitions present in ``rows``, which may read ``path``: by way of a complete copy in ``staging``."""
    write_clustered(as_declared(rows, schema), staging, column, cluster)
    finish_replacing(rows.sparkSession, path, staging, column)


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence) -> None:
    for value in values:
        files, folder = file_system(spark, f"{path}/{column}={value}")
        files.delete(folder, True)


def clustered(df: DataFrame, partition: str, cluster: Sequence[str]) -> DataFrame:
    """Rows brought together by partition value, each task sorted by ``cluster``.

    The rebalance splits a hot month or day over several tasks and files, by the sizes the exchange measured:
    unlike a range split it does not sample its input, so what computes ``df`` runs once.
    """
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster)


def placed(df: DataFrame, partition: str, cluster: Sequence[str], counts: DataFrame, rows_per_file: int = ROWS_PER_FILE,
           widen: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows in as many tasks as their number asks for, each with a range of (folder, ``cluster[0]``): the files of a hot folder have ranges apart.

    ``counts`` has the ``rows`` of each partition value and location (``cluster[0]``); it may overstate them, as it only
    sets the bounds. It is small and read thrice, so it should be stored. A location lies at its share of all rows that come before it in order, in
    each folder alike. Unlike a range split by Spark this does not sample ``df``, so what computes it runs once. A location of a folder
    stays in one task. Where the locations measure more than a broadcast may, rows are clustered by folder alone.
    ``widen`` adds columns once the rows are where they belong (a broadcast join, no exchange), so that these are not shuffled.
    """
    widen = widen or (lambda rows: rows)
    by, spark = cluster[0], df.sparkSession
    folders = counts.groupBy(partition).agg(F.sum("rows").alias("_in_folder"))
    places = counts.groupBy(by).agg(F.sum("rows").alias("_in_place"))
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    if not total or measured_bytes(places) > BROADCAST_LIMIT_BYTES:
        return widen(df.hint("rebalance", F.col(partition))).sortWithinPartitions(partition, *cluster)
    # Small tables use all tasks that a shuffle has.
    size = min(rows_per_file, math.ceil(total / int(spark.conf.get("spark.sql.shuffle.partitions"))))
    tasks = math.ceil(total / size)
    # One row a folder, bounded by the calendar, and one a location, of the measured size: these windows have one task.
    before = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, -1)
    starts = folders.select(F.col(partition).alias("_folder"), "_in_folder",
                            F.coalesce(F.sum("_in_folder").over(before.orderBy(partition)), F.lit(0)).alias("_start"))
    shares = places.select(F.col(by).alias("_place"), (F.coalesce(F.sum("_in_place").over(before.orderBy(by)), F.lit(0)) / total).alias("_share"))
    found = df.join(F.broadcast(starts), F.col(partition).eqNullSafe(F.col("_folder")), "left").join(
        F.broadcast(shares), F.col(by).eqNullSafe(F.col("_place")), "left")
    at = F.coalesce((F.col("_start") + F.col("_share") * F.col("_in_folder")) / size, F.lit(0))
    sent = found.withColumn("_task", F.least(F.floor(at), F.lit(tasks - 1)).cast("int")).repartitionById(tasks, F.col("_task"))
    return widen(sent.select(df.columns)).sortWithinPartitions(partition, *cluster)


def write_clustered(df: DataFrame, path: str, partition: str, cluster: Sequence[str], counts: DataFrame | None = None) -> None:
    """One folder per partition value; with ``counts`` the locations of a folder's files are ranges apart (see ``placed``)."""
    rows = clustered(df, partition, cluster) if counts is None else placed(df, partition, cluster, counts)
    write_folders(rows, path, partition)


def write_folders(rows: DataFrame, path: str, partition: str) -> None:
    """One folder per partition value, of rows that already lie together by it."""
    write_parquet(rows, path, partition, "overwrite")


def write_daily_facts(df: DataFrame, path: str, counts: DataFrame | None = None) -> None:
    """Facts or alerts: a folder per month, clustered by location."""
    write_clustered(df, path, "year_month", ["location_id", "date"], counts)


def write_hourly_facts(df: DataFrame, path: str, counts: DataFrame | None = None) -> None:
    """A folder per day, clustered by location and mesoregion."""
    write_clustered(df, path, "date", ["location_id", "mesoregion", "observed_at"], counts)
