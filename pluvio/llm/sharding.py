"""Sharding by proportional stratified interleaving.

Rows of a source are put in a seeded order; a row's fractional rank is (rank + 1/2) / rows of the source.
Sorted by that, sources are interleaved in proportion, and cutting the order into equal parts gives
shards whose counts differ by at most one and whose mixture is that of the whole.

Both ranks come from counted pieces (``ranked``), so neither a hot source nor the whole table is ever
sorted in one task. Nulls: a null text has no bytes, a null source is a stratum of its own, a null id
has one fixed place in the order. Rows alike in every column are interchangeable. Empty tables give
empty results; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pluvio.llm.common import ranked, seeded_key, stored
from pluvio.operators.joins import small_side

SEED = "shard-1"
# Pieces a source (hex digits of the key) and the interleaved order are counted in.
BUCKET_DIGITS = 3
SLICES = 8192


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def interleaved(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, text_crc32 and ``_at``, the gapless place in the interleaved order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", "source", (text_bytes(F.col("text")) + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        seeded_key(F.col("doc_id"), seed).alias("_key"),
    ).withColumn("_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    rows = stored(rows, "shard-rows")
    totals = rows.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("_total"))
    tie = [F.col("_key"), F.col("text_crc32"), F.col("size")]
    rows = ranked(rows, ["source"], "_bucket", tie, "_rank")
    rows = rows.join(small_side(totals), F.col("source").eqNullSafe(F.col("_source")), "left")
    rows = rows.withColumn("_part", (2 * F.col("_rank") + 1) / (2 * F.col("_total")))
    rows = rows.withColumn("_slice", F.floor(F.col("_part") * SLICES).cast("int")).withColumn("_all", F.lit(0))
    rows = stored(rows.drop("_bucket", "_source", "_total"), "shard-ranks")
    order = [F.col("_part"), F.col("source").asc_nulls_last(), F.col("_rank")]
    return ranked(rows, ["_all"], "_slice", order, "_at")


def shard(docs: DataFrame, shards: int = 8, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, text_crc32, shard and the gapless slot there."""
    placed = interleaved(docs, seed)
    rows = max(1, docs.count())
    # Place a lies in shard a * shards div rows; a shard starts at ceil(shard * rows / shards).
    cut = placed.withColumn("shard", F.expr(f"int(_at * {shards} div {rows})"))
    start = F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")
    return cut.select("doc_id", "source", "size", "text_crc32", "shard", (F.col("_at") - start).alias("slot"))
