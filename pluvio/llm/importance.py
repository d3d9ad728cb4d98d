"""Importance resampling towards a target: documents drawn by how much more often the target has their features.

Features are runs of consecutive words, hashed to buckets by CRC-32. The words of many texts are laid end to end
and told apart by an Arrow dictionary, so that each distinct feature is hashed once a run: distinct features of equal length
form a two-dimensional array of bytes, the checksums of all its rows are updated column by column, and the buckets are
scattered back to the places of the features. Each text's buckets are stored, so texts are read and cut once;
counting them, and summing the gains of a document, are array look-ups.

A bucket's gain is the logarithm of its share among the target's features over its share among the documents', both
smoothed by one. A document's score adds noise that its id fixes, so that the highest scores are a draw without
replacement (Gumbel top-k) that a rerun repeats. Ranks come from range pieces that are counted first, never from one sorted task; rows
alike in score and id, of whatever number, are spread over the pieces by their place in the stored table.

A null or empty text has no features, weight 0 and is never drawn with ``min_words`` above 0. Every row of a repeated id is scored
and may be drawn; ties go to the smaller id, then to fewer features. A null id takes the noise of an empty one and comes last among ties. Very long texts
are taken whole. Columns besides doc_id and text are passed over. Without documents there are no rows; without target
texts every share of the target is alike.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from pluvio.llm.common import byte_runs, ranked, stored
from pluvio.operators.joins import small_side

BUCKETS, SEED, PERCENT, MIN_WORDS = 10_000, 2024, 10, 20
# Longest feature hashed column by column; a longer one, as in texts without marks or blanks, stands alone in its length and is hashed alone.
LONGEST_COLUMNS = 64
# Rows that a range piece of the ranks should hold.
PIECE_ROWS = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _crc_table() -> np.ndarray:
    """The checksum's step for every byte: the reflected polynomial 0xEDB88320."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()


def crc32_rows(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a two-dimensional array of bytes, all rows a column at a time."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = _CRC[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
    return ~crc


def crc32_values(values: pa.BinaryArray) -> np.ndarray:
    """CRC-32 of every value, by arrays of values of equal length."""
    _, bounds, data = values.buffers()
    bounds = np.frombuffer(bounds, np.int32)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lengths = np.diff(bounds)
    order = np.argsort(lengths, kind="stable")
    out = np.empty(len(values), np.uint32)
    for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if not len(part):
            continue
        size = int(lengths[part[0]])
        if size > LONGEST_COLUMNS:
            out[part] = [zlib.crc32(data[bounds[i] : bounds[i] + size]) for i in part]
        else:
            out[part] = crc32_rows(data[bounds[part][:, None] + np.arange(size)])
    return out


def feature_buckets(texts: Sequence[bytes | None], longest: int = 1, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """Of each text the number of its words and the bucket of every run of 1 to ``longest`` of them, repeats included."""
    for run in byte_runs(texts):
        data = _LOWER[np.frombuffer(b"\n".join([*run, b""]), np.uint8)]
        inside = _IN_WORD[data]
        before = np.concatenate([[False], inside[:-1]])
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
        firsts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in run])])
        bounds = np.searchsorted(starts, firsts)
        # Words one blank apart: a run of words is a slice of these bytes.
        data[ends] = 0x20
        inside[ends] = True
        data = data[inside]
        at = np.concatenate([[0], np.cumsum(ends - starts + 1)])
        text_of = np.repeat(np.arange(len(run)), np.diff(bounds))
        owners, found = [], []
        for words in range(1, longest + 1):
            first = np.arange(max(0, len(starts) - words + 1))
            first = first[text_of[first] == text_of[first + words - 1]]
            found.append(_hashed(data, at[first], at[first + words] - 1, buckets))
            owners.append(text_of[first])
        owner, bucket = np.concatenate(owners), np.concatenate(found)
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(run) + 1))
        for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            yield int(bounds[i + 1] - bounds[i]), bucket[order[a:b]]


def _hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int) -> np.ndarray:
    lengths = ends - starts
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    gathered = data[np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])]
    values = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(gathered)])
    encoded = values.dictionary_encode()
    return (crc32_values(encoded.dictionary) % np.uint32(buckets))[encoded.indices.to_numpy()]


def hashed(docs: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, its place among all rows, the number of words and of features, and the features' buckets (4 bytes each)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = TaskContext.get().partitionId() << 40
        for frame in batches:
            out = [(words, len(b), b.astype("<u4").tobytes()) for words, b in feature_buckets(frame["text"].tolist(), longest, buckets)]
            result = pd.DataFrame(out, columns=["words", "n_features", "buckets"])
            result["doc_id"], result["place"] = frame["doc_id"].tolist(), place + np.arange(len(frame))
            place += len(frame)
            yield result[["doc_id", "place", "words", "n_features", "buckets"]]

    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    read = read.mapInPandas(rows, "doc_id string, place long, words long, n_features long, buckets binary")
    return read.withColumn("doc_id", F.col("doc_id").cast("long"))


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features lie in each bucket. A task adds up its rows; at most ``buckets`` sums reach the driver."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for frame in batches:
            total += np.bincount(np.frombuffer(b"".join(frame["buckets"]), "<u4"), minlength=buckets)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some, "n": total[some]})

    sums = features.select("buckets").mapInPandas(rows, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():
        out[row.bucket] = row.n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share in the target over that in the documents, rounded down."""
    size, all_docs, all_target = len(documents), float(documents.sum()), float(target.sum())
    ratios = [(t + 1.0) * (all_docs + size) / ((s + 1.0) * (all_target + size)) for s, t in zip(documents.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weighted(features: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, place, words, n_features, weight and score."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            of = gain[np.frombuffer(b"".join(frame["buckets"]), "<u4")]
            upto = np.concatenate([[0], np.cumsum(of)])
            ends = frame["n_features"].cumsum().to_numpy()
            weight = upto[ends] - upto[ends - frame["n_features"].to_numpy()]
            yield frame[["doc_id", "place", "words", "n_features"]].assign(weight=weight)

    summed = features.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        rows, "doc_id string, place long, words long, n_features long, weight long"
    )
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("doc_id", F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    noise = F.floor(-1000 * F.ln(-F.ln(share)))
    return summed.withColumn("score", F.col("weight") + noise).withColumn("doc_id", F.col("doc_id").cast("long"))


def draw(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, longest: int = 1,
    buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; of ``percent`` of the rows with ``min_words`` words the rank, else null."""
    features = stored(hashed(docs, longest, buckets), "features")
    aimed = hashed(target.select(F.lit(0).alias("doc_id"), "text"), longest, buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(aimed, buckets))
    scored = stored(weighted(features, gain, seed), "scored")
    may = F.col("words") >= min_words
    rows = scored.filter(may).count()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc(), F.col("place").asc()]
    pieces = max(1, math.ceil(rows / PIECE_ROWS), min(rows, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = scored.filter(may).repartitionByRange(pieces, *order).withColumn("_piece", F.spark_partition_id())
    placed = ranked(stored(dealt, "pieces"), [], "_piece", order, "_rank")
    rank = F.when(F.col("_rank") < percent * rows // 100, F.col("_rank") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*columns, rank.alias("rank")).union(scored.filter(~may).select(*columns, F.lit(None).cast("long")))


def sample(docs: DataFrame, drawn: DataFrame) -> DataFrame:
    """The documents of ids that ``draw`` ranked, all columns kept."""
    ids = drawn.filter("rank is not null and doc_id is not null").select("doc_id").distinct()
    return docs.join(small_side(ids), "doc_id", "left_semi").select(docs.columns)
