"""Mixing sources to target weights by capped water-filling.

Every source gets the share of its weight in the words to take, but at most ``max_epochs`` times its own
words; what a capped source leaves goes to the others by weight until no one is above its cap. A source
is then taken in whole repetitions plus a seeded part: its documents in an order that depends on seed
and id alone, up to the document whose end comes nearest to the target.

Nulls: a null text counts no words, a null source is a source of its own (the last), a null id has one
fixed place in the order. Rows of the same id are taken together. Empty tables give empty results;
columns besides doc_id, text and source are passed through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from pluvio.llm.common import seeded_key, set_apart, stored, word_count
from pluvio.operators.joins import small_side

SEED = "mix-1"
# Hex digits of the key that cut a source into pieces: 4,096, so that only one piece of a source is ever sorted.
BUCKET_DIGITS = 3


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, source, size in words and place in the seeded order, stored."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), seeded_key(F.col("doc_id"), seed).alias("key"))
    return stored(rows, "mix-sized")


def cycle_weights(sources: DataFrame, cycle: Sequence[float]) -> DataFrame:
    """Adds ``weight``: the cycle's values in turn, sources by code point, null last. One row a source."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    return sources.withColumn("weight", F.element_at(weights, (place % len(cycle) + 1).cast("int")))


def water_fill(sources: DataFrame, budget: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight).

    In the order of cap by weight, a source is capped while its cap is within its share of what the sources
    before it left; all others stand at one level. This is where repeated clamping and resharing ends.
    """
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    capped = F.col("cap") <= F.col("level") * F.col("weight")
    left = F.sum("source_size").over(everything) * F.lit(float(budget)) - F.coalesce(
        F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)
    )
    return (
        sources.withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
        .withColumn("level", left / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("water", F.max(F.when(~capped, F.col("level"))).over(everything))
        .withColumn("target", F.when(capped, F.col("cap")).otherwise(F.col("water") * F.col("weight")))
        .drop("cap", "level", "water")
    )


def repetitions(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """For every source: source_size, target, ``whole`` repetitions, and the last key (``cutoff``) of the part taken once more."""
    plan = targets.withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    bucket = F.substring("key", 1, BUCKET_DIGITS)
    pieces = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("piece"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumn("start", F.coalesce(F.sum("piece").over(before), F.lit(0)))
    plan_by = small_side(plan.select(F.col("source").alias("_source"), "rest"))
    # The piece in which the rest ends; only its documents are sorted.
    edge = pieces.join(plan_by, F.col("source").eqNullSafe(F.col("_source"))).filter(
        (F.col("rest") > 0) & (F.col("start") < F.col("rest")) & (F.col("start") + F.col("piece") >= F.col("rest"))
    )
    edge = small_side(edge.select("_source", F.col("bucket").alias("_bucket"), "start", "rest"))
    here = rows.withColumn("bucket", bucket).join(
        edge, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    )
    units = here.groupBy("source", "bucket", "key").agg(F.sum("size").alias("size"), F.first("start").alias("start"), F.first("rest").alias("rest"))
    ahead = W.partitionBy("source", "bucket").orderBy("key").rowsBetween(W.unboundedPreceding, -1)
    middle = F.col("start") + F.coalesce(F.sum("size").over(ahead), F.lit(0)) + F.col("size") / 2
    cut = (
        units.withColumn("middle", middle)
        .groupBy("source")
        .agg(F.max(F.when(F.col("middle") <= F.col("rest"), F.col("key"))).alias("_in"), F.min("bucket").alias("_edge"))
        .select(F.col("source").alias("_source"), F.coalesce("_in", "_edge").alias("cutoff"))
    )
    # A bare bucket prefix sorts before every key of that bucket, so it takes the pieces before it and nothing of it.
    return plan.join(small_side(cut), F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", "whole", "cutoff"
    )


def plan_mixture(rows: DataFrame, cycle: Sequence[float] = (3, 1, 2), budget: float = 1.5, max_epochs: float = 2.0) -> DataFrame:
    """The repetitions of every source, from ``sized`` rows."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = water_fill(cycle_weights(sources, cycle), budget, max_epochs)
    return stored(repetitions(rows, targets), "mix-plan")


def with_repeats(docs: DataFrame, plan: DataFrame, seed: str = SEED) -> DataFrame:
    """``docs`` with ``_repeats``, and ``_source_size`` and ``_target`` of its source; no exchange of the documents while the plan is small."""
    by = small_side(plan.select(F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), "whole", "cutoff").withColumnsRenamed({"whole": "_whole", "cutoff": "_cutoff"}))
    once_more = F.coalesce(seeded_key(F.col("doc_id"), seed) <= F.col("_cutoff"), F.lit(False)).cast("long")
    joined = docs.join(by, docs["source"].eqNullSafe(F.col("_source")))
    return joined.withColumn("_repeats", F.col("_whole") + once_more).drop("_source", "_whole", "_cutoff")


def mix(docs: DataFrame, cycle: Sequence[float] = (3, 1, 2), budget: float = 1.5, max_epochs: float = 2.0, seed: str = SEED) -> DataFrame:
    """The mixture itself: every row of ``docs`` as many times as it is taken. Its columns stay, whatever their names."""
    shielded, own = set_apart(docs, "_source", "_source_size", "_target", "_whole", "_cutoff", "_repeats", "_copy")
    repeated = with_repeats(shielded, plan_mixture(sized(docs, seed), cycle, budget, max_epochs), seed)
    copies = repeated.filter(F.col("_repeats") > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_repeats"))))
    return copies.select(own)
