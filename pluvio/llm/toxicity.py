"""Toxicity by non-negative positive-unlabelled learning.

A logistic classifier is trained in numpy from confirmed toxic examples and unlabelled text. With the class
prior p, the risk is p * loss(toxic as 1) + max(0, loss(unlabelled as 0) - p * loss(toxic as 0)): what the toxic part of
the unlabelled text adds is taken off again, and where that would make the second term negative, its
gradient is turned round.

Features are which words a text holds, and which beginnings of words (4, 5 and 6 bytes), so that inflected and
compound forms of a learned word count too; A-Z are lower-cased and everything else that is ASCII and no
letter separates words. Texts are read whole. The ``FEATURES`` most telling ones are kept by their rates in toxic and unlabelled text.

Fitted on at most ``MAX_POSITIVE`` toxic and ``MAX_UNLABELLED`` other texts, picked by a seeded hash of the id; both are
parameters. Scoring needs no exchange. A null or empty text has no features and scores as the intercept says; without
any toxic example every score is 0. A label counts if any row of the document's id is marked toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pluvio.llm.common import held_out, seeded_key, stored
from pluvio.llm.words import _BYTE, _LOWER, _power_tables, chunks, mix

MAX_POSITIVE, MAX_UNLABELLED = 6_000, 18_000
FEATURES = 1024
# Standard deviations by which a feature's count in toxic text is lowered before features are compared.
CAUTION = 2.0
# Penalty on a weight's size, divided by the number of toxic examples.
SPARSE = 0.04
PREFIXES = (4, 5, 6)
FOLDS, HELD_OUT = 4, 2
CUT = 0.3
SEED = "toxic-1"

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def features(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: index of the first, number of texts, and the (feature, text) occurrences in the run."""
    for first, run in chunks(texts):
        data = _LOWER[np.frombuffer(b" ".join([*run, b""]), np.uint8)]
        letter = _LETTER[data]
        before = np.empty_like(letter)
        before[0], before[1:] = False, letter[:-1]
        starts, ends = np.flatnonzero(letter & ~before), np.flatnonzero(~letter & before)
        up, down = _power_tables(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up, out=sums[1:])
        firsts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in run])])
        text = np.searchsorted(firsts, starts, side="right") - 1
        found, where = [mix((sums[ends] - sums[starts]) * down[starts])], [text]
        for length in PREFIXES:
            long = ends - starts >= length
            at = starts[long]
            found.append(mix((sums[at + length] - sums[at]) * down[at] + np.uint64(length)))
            where.append(text[long])
        yield first, len(run), np.concatenate(found), np.concatenate(where)


@dataclass(frozen=True)
class Model:
    """Weights of feature hashes (ascending) and the intercept."""

    hashes: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.intercept)
        if len(self.hashes):
            for first, number, found, where in features(texts):
                at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
                hit = self.hashes[at] == found
                once = np.unique(where[hit] * len(self.hashes) + at[hit])
                np.add.at(out, first + once // len(self.hashes), self.weights[once % len(self.hashes)])
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(rows: list[np.ndarray], positive: np.ndarray, hashes: np.ndarray, prior: float, turns: int = 400, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Minimises the non-negative risk by Adam over all rows; ``rows`` hold the feature numbers of each text."""
    n, sizes = len(hashes), np.array([len(r) for r in rows])
    feature = np.concatenate([np.asarray(r, np.int64) for r in rows] or [np.empty(0, np.int64)])
    row = np.repeat(np.arange(len(rows)), sizes)
    positive = positive.astype(bool)
    share = np.where(positive, 1.0 / max(1, positive.sum()), 1 / max(1, (~positive).sum()))
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    w[n] = np.log(prior / (1 - prior))
    # Few examples ask for few words.
    sparse = np.append(np.full(n, SPARSE / max(1, positive.sum())), 0.0)
    for turn in range(1, turns + 1):
        z = np.bincount(row, w[feature], len(rows)) + w[n]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        as_zero = np.logaddexp(0, z) * share
        negative_risk = as_zero[~positive].sum() - prior * as_zero[positive].sum()
        # d loss(as 1)/dz = p - 1 and d loss(as 0)/dz = p
        pull = np.where(positive, prior * (p - 1) * share, 0.0)
        push = np.where(positive, -prior * p * share, p * share)
        slope = pull + push if negative_risk >= 0 else -push
        gradient = np.append(np.bincount(feature, slope[row], n), slope.sum()) + decay * np.append(w[:n], 0.0) + sparse
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
        # Words speak for toxicity or not at all; no text gets safe by adding harmless ones.
        w[:n] = np.maximum(w[:n], 0.0)
    return Model(hashes, w[:n], float(w[n]))


def telling(positive: np.ndarray, other: np.ndarray, positives: int, others: int, prior: float, keep: int) -> np.ndarray:
    """Positions of the features that speak most for toxic text: log-odds by the squared root of how often toxic text has them.

    The rate in toxic text is taken at its lower confidence bound, so that words of a few texts do not pass for a pattern.
    """
    p = np.maximum(positive - CAUTION * np.sqrt(positive), 0) / max(1, positives)
    u = other / max(1, others)
    n = np.maximum(u - prior * positive / max(1, positives), 0) / (1 - prior) + 1 / (others + 1)
    gain = np.where(p > 4 * n, np.log(np.maximum(p, 1e-12) / n) * np.sqrt(p), 0.0)
    order = np.lexsort((np.arange(len(gain)), -gain))[:keep]
    return np.sort(order[gain[order] > 0])


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, prior: float | None = None,
          max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, keep: int = FEATURES, seed: str = SEED) -> Model:
    """Learns from the labels for which ``learn`` holds; ``prior`` defaults to the toxic share of these."""
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col("toxic").alias("toxic")).filter("doc_id is not null and toxic is not null")
    known = known.filter(learn) if learn is not None else known
    toxic = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sums = toxic.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    if not sums.toxic:
        return Model(np.empty(0, np.uint64), np.empty(0), -30.0)
    prior = prior if prior is not None else min(0.5, sums.toxic / sums.n)
    key = seeded_key(F.col("doc_id"), seed)
    # Both lists of ids are bounded by parameters.
    positives = toxic.filter("toxic = 1").orderBy(key).limit(max_positive).select("doc_id", F.lit(1).alias("toxic"))
    ids = docs.select("doc_id").filter("doc_id is not null")
    # Drawn from all texts, the toxic ones among them, as the prior says.
    others = (ids.filter(learn) if learn is not None else ids).distinct().orderBy(key).limit(max_unlabelled).select("doc_id", F.lit(0).alias("toxic"))
    chosen = stored(positives.union(others), "toxic-sample")

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for first, number, hashes, where in features(frame["text"].tolist()):
                order = np.lexsort((hashes, where))
                hashes, where = hashes[order], where[order]
                once = np.append(True, (np.diff(hashes) != 0) | (np.diff(where) != 0)) if len(hashes) else np.empty(0, bool)
                hashes, bounds = hashes[once], np.searchsorted(where[once], np.arange(number + 1))
                rows = [hashes[a:b].view(np.int64).tolist() for a, b in zip(bounds[:-1], bounds[1:])]
                part = frame.iloc[first : first + number]
                yield pd.DataFrame({"toxic": part["toxic"].to_numpy(), "same": part["same"].to_numpy(), "features": rows})

    # Of a repeated id one text, so that the bounds hold for rows too.
    first = F.min(F.struct(F.xxhash64("text").alias("same"), F.col("text").alias("text"))).alias("first")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(first)
    texts = texts.select("toxic", "first.text", "first.same")
    # A text that was copied often is one example.
    sample = texts.mapInPandas(found, "toxic int, same long, features array<long>").dropDuplicates(["toxic", "same"])
    sample = stored(sample, "toxic-features")
    totals = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(1):
        return Model(np.empty(0, np.uint64), np.empty(0), -30.0)
    each = sample.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count_if(F.col("toxic") == 1).alias("positive"), F.count_if(F.col("toxic") == 0).alias("other")
    )
    # Features of a few toxic texts tell nothing of others; the rest is bounded by the sample.
    least = max(3, round(totals[1] * 0.005))
    counted = each.filter(F.col("positive") >= least).toPandas().sort_values("feature")
    best = telling(counted["positive"].to_numpy(), counted["other"].to_numpy(), totals[1], totals.get(0, 0), prior, keep)
    hashes = np.sort(counted["feature"].to_numpy(np.int64).view(np.uint64)[best])
    signed = np.sort(hashes.view(np.int64))
    kept = sample.select("toxic", F.array_intersect("features", F.lit(signed.tolist()).cast("array<bigint>")).alias("features")).toPandas()
    rows = [np.searchsorted(hashes, np.sort(np.asarray(r, np.int64).view(np.uint64))) for r in kept["features"]]
    return fit(rows, kept["toxic"].to_numpy() == 1, hashes, prior)


def scored(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the score; other columns pass through."""
    score = F.pandas_udf(lambda texts: pd.Series(model.scores(texts.tolist())), "double")
    return docs.withColumn(column, score("text"))


def learning_rows() -> Column:
    return ~held_out(F.col("doc_id"), FOLDS, HELD_OUT)
