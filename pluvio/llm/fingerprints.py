"""Bottom-k sketches of five-word shingles.

A sketch is the ascending array of the k smallest distinct shingle hashes of a text. Sketches merge by
keeping the k smallest of their union, so parts of a text collection can be sketched apart. From two
sketches follow resemblance, containment and distinct shingle counts; while a text has at most k
distinct shingles, all of these are exact.

Words are what lies between white space, A-Z lower-cased; a text of one to four words is one shingle, a
text without words (or a null one) has the empty sketch. Two empty sketches resemble each other fully,
an empty and another one not at all. Very long texts are taken whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pluvio.llm.common import WORD, stored
from pluvio.operators.joins import small_side

K = 128
WORDS = 5


def lowered(text: Column) -> Column:
    """A-Z only; other letters stay, as the shingle's definition asks."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hashes of all runs of ``words`` words, repeats included."""
    hashes = F.transform(F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(1), F.size(h) - (words - 1)), lambda i: F.xxhash64(*[F.element_at(h, i + j) for j in range(words)])
        )
        return F.when(F.size(h) >= words, several).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    # One element, so that the word hashes are computed once and not for each use.
    return F.flatten(F.transform(F.array(hashes), runs))


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, k: int = K) -> Column:
    return bottom(shingle_hashes(text), k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    return bottom(F.concat(a, b), k)


def merge_all(df: DataFrame, keys: list[str], column: str, k: int = K) -> DataFrame:
    """The sketch of each group's union: hashes are made distinct and ranked before any array is built, so a group is never held whole."""
    each = df.select(*keys, F.explode(column).alias("_hash")).distinct()
    rank = F.row_number().over(W.partitionBy(*keys).orderBy("_hash"))
    kept = each.withColumn("_rank", rank).filter(F.col("_rank") <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's bottom k that both have."""

    def share(union: Column) -> Column:
        both = F.array_intersect(F.array_intersect(union, a), b)
        return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(F.size(both) / F.size(union))

    return F.element_at(F.transform(F.array(merge(a, b, k)), share), 1)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    # Hashes are spread evenly over 2^64 values from -2^63 on.
    reached = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / reached)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too, from resemblance and the two counts."""
    j = resemblance(a, b, k)
    shared = j / (1 + j) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def encoded(a: Column) -> Column:
    """A sketch as text: 16 hex digits a hash."""
    return F.concat_ws("", F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")))


def pieces_by_id(docs: DataFrame, piece_rows: int, most: int) -> tuple[Column, int]:
    """A column that cuts doc_id, falling, into non-empty pieces of about ``piece_rows`` rows, and their number (at most ``most`` + 2)."""
    ids = docs.agg(F.count(F.lit(1)).alias("rows"), F.min("doc_id").alias("low"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    wanted = min(most, max(1, math.ceil(ids.rows / piece_rows)))
    at = [i / (wanted + 1) for i in range(1, wanted + 1)]
    cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", at, 10 * wanted + 1000)).first()[0] or []), reverse=True)
    # How many cuts lie above the id: first among every width-th cut, then among those between two of them.
    width = math.isqrt(max(1, len(cuts) - 1)) + 1
    every, coarse = F.lit(cuts or [0]), F.lit(cuts[::width] or [0])

    def above(values: Column) -> Column:
        return F.size(F.filter(values, lambda cut: cut > F.col("doc_id")))

    block = F.greatest(above(coarse) - 1, F.lit(0))
    place = block * width + above(F.slice(every, block * width + 1, width))
    # The smallest id may be the last cut itself; then no id lies below it.
    known = len(cuts) + (ids.low is not None and ids.low < cuts[-1])
    return F.when(F.col("doc_id").isNull(), F.lit(known)).otherwise(place), known + (ids.nulls > 0)


def with_next(docs: DataFrame, columns: list[str], piece_rows: int = 1024, most: int = 65_536) -> DataFrame:
    """Every row with ``_next``: a struct of ``columns`` of the row that follows in descending doc_id (after the last: the first).

    Inside a piece of the order a window finds the next row; the last row of a piece takes the first row of
    the next piece, from a table of one row a piece. Null ids come last, in one piece; rows of equal ids
    follow each other in the order of ``columns``.
    """
    piece, pieces = pieces_by_id(docs, piece_rows, most)
    rows = docs.withColumn("_piece", piece)
    fields = [F.col(c) for c in columns]
    first = F.min(F.struct(F.bitwise_not("doc_id").alias("_order"), *fields))
    firsts = stored(rows.groupBy("_piece").agg(first.alias("_first")), "piece-firsts").select(
        ((F.col("_piece") + (pieces - 1)) % F.lit(max(1, pieces))).alias("_before"), F.struct(*[F.col(f"_first.{c}") for c in columns]).alias("_first")
    )
    order = [F.col("doc_id").desc_nulls_last(), *fields]
    rows = rows.withColumn("_next", F.lead(F.struct(*fields)).over(W.partitionBy("_piece").orderBy(*order)))
    joined = rows.join(small_side_of_structs(firsts), F.when(F.col("_next").isNull(), F.col("_piece")) == F.col("_before"), "left")
    return joined.withColumn("_next", F.coalesce("_next", "_first")).drop("_piece", "_before", "_first")


def small_side_of_structs(firsts: DataFrame) -> DataFrame:
    """``firsts`` with a broadcast hint if its rows measure little enough, by the length of their text form."""
    return small_side(firsts.withColumn("_text", F.to_json("_first"))).drop("_text")


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, n_chars, the edited text's sha256, both fingerprints and the likenesses.

    The edited text is the text with its last third replaced by as many leading characters (or all) of the
    next document in descending doc_id.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = with_next(docs.select("doc_id", text.alias("_text"), sketch(F.col("text"), k).alias("_own")), ["_text", "_own"])
    third = F.floor(F.char_length("_text") / 3).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), F.char_length("_text") - third), F.substring(F.col("_next._text"), F.lit(1), third))
    rows = rows.select("doc_id", "_own", F.char_length("_text").cast("long").alias("n_chars"), edited.alias("_edited"), F.col("_next._own").alias("_next"))
    rows = rows.withColumn("_other", sketch(F.col("_edited"), k))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"),
        encoded(F.col("_own")).alias("fingerprint"), encoded(F.col("_other")).alias("edited_fingerprint"),
        resemblance(F.col("_own"), F.col("_other"), k).alias("near_edited"), resemblance(F.col("_own"), F.col("_next"), k).alias("near_next"),
    )
