"""Quality by a generalised additive model with pairwise interactions.

Each feature is cut into bins at quantiles. Boosting goes round the features in turn and fits a shallow
tree (at most four leaves) on one feature's bins to the gradient of the logistic loss; its small steps add up to a
lookup table per feature. Then the pairs of features that explain most of what is left get tables of their own,
fitted in the same way by trees with one cut in each of the two. A score is the sum of looked-up values, added bin by bin for
all rows at once, through the logistic function.

Features come from the whole text alone: lengths, alphabets, marks, repeats, and the worst stretch of
``STRETCH`` words. Fitted on at most ``MAX_ROWS`` labelled texts (a parameter), picked by a seeded hash of the id.
A null text counts as empty; an empty text has features of zero. Without labels every score is 0.5.
Scoring needs no exchange.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pluvio.llm.common import held_out, seeded_key, stored
from pluvio.llm.words import _power_tables, _BYTE, _WHITE, chunks, mix

MAX_ROWS = 20_000
FOLDS, HELD_OUT = 3, 1
SEED = "quality-1"
BINS, PAIR_BINS, PAIRS = 32, 12, 10
STRETCH = 32
NAMES = (
    "log_words", "log_bytes", "word_bytes", "upper", "digit", "mark", "other_mark", "wide", "sentence_words",
    "line_words", "log_lines", "distinct_words", "repeated_words", "log_run", "distinct_runs", "top_word",
    "marked_words", "upper_words", "worst_mark", "worst_upper", "worst_repeat", "worst_distinct", "longest_word",
)

_UPPER, _DIGIT, _MARK, _OTHER = (np.zeros(256, np.int64) for _ in range(4))
_UPPER[65:91] = 1
_DIGIT[48:58] = 1
_MARK[[*b".,;:!?'\"-()"]] = 1
_OTHER[[*b"#$%&*+/<=>@[\\]^_`{|}~"]] = 1
_END = np.zeros(256, np.int64)
_END[[*b".!?"]] = 1


def _sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values)])


def _longest_run(same: np.ndarray) -> int:
    """Length of the longest stretch of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
    return int((edges[1::2] - edges[::2]).max()) if len(edges) else 0


def _distinct(values: np.ndarray) -> tuple[int, int]:
    """How many distinct values, and how often the most frequent one occurs."""
    values = np.sort(values)
    cuts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
    return len(cuts) - 1, int(np.diff(cuts).max())


def measure(texts: list[str | None]) -> np.ndarray:
    """One row of features for each text."""
    out = np.zeros((len(texts), len(NAMES)))
    for first, run in chunks(texts):
        data = np.frombuffer(b" ".join([*run, b""]), np.uint8)
        white = _WHITE[data]
        before = np.concatenate([[True], white[:-1]])
        starts, ends = np.flatnonzero(~white & before), np.flatnonzero(white & ~before)
        up, down = _power_tables(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up, out=total[1:])
        hashes = mix((total[ends] - total[starts]) * down[starts])
        byte_sums = [_sums(t[data]) for t in (_UPPER, _DIGIT, _MARK, _OTHER, _END)] + [_sums(data > 127), _sums(data == 10)]
        upper, digit, mark, other, end, wide, line = byte_sums
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in run])])
        words = np.searchsorted(starts, bounds)
        size = ends - starts
        marked = (other[ends] - other[starts] > 0) | (mark[ends] - mark[starts] > 1)
        shouted = (upper[ends] - upper[starts]) * 2 > size
        same = np.concatenate([[False], hashes[1:] == hashes[:-1]])
        gaps = size.astype(np.float64)
        for i in range(len(run)):
            a, b, s, e = words[i], words[i + 1], bounds[i], bounds[i + 1] - 1
            n, length = b - a, e - s
            if not n:
                continue
            again = same[a:b].copy()
            again[0] = False
            different, most = _distinct(hashes[a:b])
            runs = hashes[a:b]
            triples = _distinct(mix(runs[:-2] + runs[1:-1] * np.uint64(3) + runs[2:] * np.uint64(5)))[0] / (n - 2) if n > 2 else 1.0
            at = np.arange(0, n, STRETCH)
            width = np.diff(np.append(at, n))
            worst = [np.add.reduceat(x.astype(np.int64), at) / np.maximum(width, STRETCH // 2) for x in (marked[a:b], shouted[a:b], again)]
            whole = n // STRETCH
            blocks = np.sort(hashes[a : a + whole * STRETCH].reshape(whole, STRETCH), axis=1)
            spread = (1 + (blocks[:, 1:] != blocks[:, :-1]).sum(1)).min() / STRETCH if whole else different / n
            lines = 1 + line[e] - line[s]
            out[first + i] = (
                np.log1p(n), np.log1p(length), gaps[a:b].mean(), (upper[e] - upper[s]) / length, (digit[e] - digit[s]) / length,
                (mark[e] - mark[s]) / length, (other[e] - other[s]) / length, (wide[e] - wide[s]) / length,
                n / (1 + end[e] - end[s]), n / lines, np.log1p(lines), different / n, again.mean(), np.log1p(_longest_run(again)), triples, most / n,
                marked[a:b].mean(), shouted[a:b].mean(), worst[0].max(), worst[1].max(), worst[2].max(), spread, np.log1p(size[a:b].max()),
            )
    return out


@dataclass
class Model:
    """Cuts and a lookup table for each feature, and the tables of pairs over coarser cuts."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for f, (cuts, values) in enumerate(zip(self.cuts, self.tables)):
            out += values[np.searchsorted(cuts, x[:, f], side="right")]
        coarse = {f: np.searchsorted(self.pair_cuts[f], x[:, f], side="right") for pair in self.pairs for f in pair}
        for (f, g), values in self.pairs.items():
            out += values[coarse[f], coarse[g]]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_cut(g: np.ndarray, h: np.ndarray, smooth: float, least: float) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram of gradients and curvatures."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + smooth) + gr**2 / (hr + smooth) - g.sum() ** 2 / (h.sum() + smooth)
    gain = np.where((hl < least) | (hr < least), -1.0, gain)
    return (float(gain.max()), int(gain.argmax()) + 1) if len(gain) else (-1.0, 0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, smooth: float, least: float) -> np.ndarray:
    """The step of a tree of depth two on one feature's bins."""
    step = np.zeros(len(g))
    gain, cut = _best_cut(g, h, smooth, least)
    parts = [slice(0, cut), slice(cut, len(g))] if gain > 0 else [slice(0, len(g))]
    for part in parts:
        gain, cut = _best_cut(g[part], h[part], smooth, least)
        inner = [slice(part.start, part.start + cut), slice(part.start + cut, part.stop)] if gain > 0 else [part]
        for leaf in inner:
            step[leaf] = -g[leaf].sum() / (h[leaf].sum() + smooth)
    return step


def _crossed_tree(g: np.ndarray, h: np.ndarray, smooth: float, least: float) -> tuple[np.ndarray, float]:
    """The step of a tree with one cut in the rows and one in the columns of a pair's table, and its gain."""
    down = lambda t: np.pad(t.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    gs, hs = down(g), down(h)
    i, j = slice(1, g.shape[0]), slice(1, g.shape[1])
    quarter = lambda s: (s[i, j], s[i, -1:] - s[i, j], s[-1:, j] - s[i, j], s[-1, -1] - s[i, -1:] - s[-1:, j] + s[i, j])
    if g.shape[0] < 2 or g.shape[1] < 2:
        return np.zeros_like(g), 0.0
    gq, hq = quarter(gs), quarter(hs)
    gain = sum(a**2 / (b + smooth) for a, b in zip(gq, hq)) - gs[-1, -1] ** 2 / (hs[-1, -1] + smooth)
    r, c = np.unravel_index(int(gain.argmax()), gain.shape)
    step = np.zeros_like(g)
    for a, b, rows, columns in zip(gq, hq, (slice(0, r + 1), slice(0, r + 1), slice(r + 1, None), slice(r + 1, None)),
                                   (slice(0, c + 1), slice(c + 1, None), slice(0, c + 1), slice(c + 1, None))):
        if b[r, c] >= least:
            step[rows, columns] = -a[r, c] / (b[r, c] + smooth)
    return step, float(gain[r, c])


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 40, rate: float = 0.15, smooth: float = 1.0, least: float = 1.0) -> Model:
    """Cyclic boosting: features first, then the chosen pairs."""
    model = Model()
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model.intercept = float(np.log(share / (1 - share)))
    model.cuts = [_cuts(x[:, f], BINS) for f in range(x.shape[1])]
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.cuts)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    raw = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-raw))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for f, at in enumerate(bins):
            g, h = slopes()
            n = len(model.tables[f])
            step = rate * _shallow_tree(np.bincount(at, g, n), np.bincount(at, h, n), smooth, least)
            model.tables[f] += step
            raw += step[at]
    model.pair_cuts = [_cuts(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.pair_cuts)]
    shape = [len(c) + 1 for c in model.pair_cuts]

    def histograms(f: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        cell, n = coarse[f] * shape[k] + coarse[k], shape[f] * shape[k]
        return np.bincount(cell, g, n).reshape(shape[f], shape[k]), np.bincount(cell, h, n).reshape(shape[f], shape[k])

    gains = {pair: _crossed_tree(*histograms(*pair), smooth, least)[1] for pair in combinations(range(x.shape[1]), 2)}
    chosen = sorted(gains, key=lambda pair: (-gains[pair], pair))[:PAIRS]
    model.pairs = {pair: np.zeros((shape[pair[0]], shape[pair[1]])) for pair in chosen}
    for _ in range(pair_rounds):
        for f, k in chosen:
            step = rate * _crossed_tree(*histograms(f, k), smooth, least)[0]
            model.pairs[f, k] += step
            raw += step[coarse[f], coarse[k]]
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, max_rows: int = MAX_ROWS, seed: str = SEED) -> Model:
    """Learns from the labels for which ``learn`` holds; of a document marked twice the larger mark counts."""
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").alias("quality")).filter("doc_id is not null and quality is not null")
    known = known.filter(learn) if learn is not None else known
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    # Bounded by the parameter.
    chosen = stored(known.orderBy(seeded_key(F.col("doc_id"), seed)).limit(max_rows), "quality-sample")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield pd.DataFrame({"quality": frame["quality"].to_numpy(), "x": measure(frame["text"].tolist()).tolist()})

    # Of a repeated id one text, so that the bound holds for rows too.
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text").alias("text"))).alias("first")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(first).select("quality", "first.text")
    sample = texts.mapInPandas(rows, "quality int, x array<double>").toPandas()
    if sample.empty:
        return Model()
    order = np.lexsort(np.array(sample["x"].tolist()).T)
    return fit(np.array(sample["x"].tolist())[order], sample["quality"].to_numpy(np.float64)[order])


def scored(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the score; other columns pass through."""
    score = F.pandas_udf(lambda texts: pd.Series(model.scores(measure(texts.tolist()))), "double")
    return docs.withColumn(column, score("text"))


def learning_rows() -> Column:
    return ~held_out(F.col("doc_id"), FOLDS, HELD_OUT)
