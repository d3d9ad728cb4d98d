"""Hierarchical multi-length packing of tokenised documents.

Documents are cut only where they are longer than the longest window: into whole windows and a rest. Pieces are
routed to the shortest tier that holds them, and a tier has windows of its own size. Windows are planned from the
longest tier down: a window opens with the longest piece left of its tier, and its gap is filled with the piece, or
pair of pieces, that fits it exactly, or else with the longest one that fits; where each tier has twice the size of the
one before, those are of shorter tiers (in the shortest, of its own). Below the longest tier only windows that come out
full are made. The pieces that fill none are joined in windows of the longest size, and a window that a shorter tier
holds belongs to that one. As only lengths matter, the plan is made from the number of pieces of each length
(at most ``window`` numbers, whatever the corpus); pieces then take the planned places by their rank among
pieces of their length. Windows are ordered by tier and attention cost (the sum of squared lengths) and dealt to step
groups in turn, so that steps hold as many windows of each tier and cost alike.

A null or empty text is the end token alone. Repeated rows are packed each. Very long texts are tokenised
whole, word by word. Columns besides doc_id and text are passed over; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain, repeat
from string import punctuation

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pluvio.llm.common import byte_runs, ranked, stored

WINDOW = 2048
TIERS = (256, 512, 1024, 2048)
END_TOKEN = 1
# Sequences of a step group.
STEP_SEQUENCES = 64
# Units whose ids a worker remembers, and the longest such unit in bytes.
MEMORY_UNITS, MEMORY_BYTES = 250_000, 48
# Marks at the end of a word that are told from it.
MOST_MARKS = 8
# Bytes of texts whose units are looked up together.
RUN_BYTES = 2 << 20
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(punctuation.encode())] = True
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_worker: dict[str, tuple] = {}


class WordTokenizer:
    """Token ids of texts, for tokenizers that drop white space and part letters from marks.

    The ids of a text are those of its units: words between blanks, and of a word that ends in a letter and marks, the marks apart. Many texts
    are cut into units at once, an Arrow dictionary tells the distinct ones, and only those are looked up or, if new, encoded; then the
    runs of ids are gathered. Units of letters are encoded many to a call and told apart by the vocabulary's word ends, all others one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # By code: where a unit's ids are, and whether it came again after the run that it was new in.
        self.codes: dict[bytes, int] = {}
        self.ids, self.bounds, self.again = np.empty(0, "<u4"), np.zeros(1, np.int64), np.empty(0, bool)

    def _alone(self, units: list[str]) -> tuple[np.ndarray, list[int]]:
        """The ids of units one after another, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), "<u4"), list(map(len, found))

    def _words(self, words: list[str]) -> tuple[np.ndarray, list[int]]:
        """The same for words of letters, which are encoded as one text."""
        ids, _ = self._alone([" ".join(words)])
        ends = np.flatnonzero(self.ends[ids])
        return (ids, np.diff(ends, prepend=-1).tolist()) if len(ends) == len(words) else self._alone(words)

    def _known(self, units: list[bytes]) -> np.ndarray:
        """The code of each unit."""
        codes = np.fromiter(map(self.codes.get, units, repeat(-1)), np.int64, len(units))
        self.again[codes[codes >= 0]] = True
        new = np.flatnonzero(codes < 0).tolist()
        if new:
            texts = [units[i].decode() for i in new]
            words, others = [k for k, t in enumerate(texts) if t.isalpha()], [k for k, t in enumerate(texts) if not t.isalpha()]
            parts = [self._words([texts[k] for k in words[at : at + 4000]]) for at in range(0, len(words), 4000)]
            parts.append(self._alone([texts[k] for k in others]))
            at = np.array([new[k] for k in chain(words, others)], np.int64)
            codes[at] = first = len(self.again) + np.arange(len(new))
            self.ids = np.concatenate([self.ids, *[ids for ids, _ in parts]])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum([n for _, sizes in parts for n in sizes])])
            self.again = np.concatenate([self.again, np.zeros(len(new), bool)])
            self.codes.update((units[i], c) for i, c in zip(at.tolist(), first.tolist()) if len(units[i]) <= MEMORY_BYTES)
        return codes

    def _forget(self) -> None:
        """Keeps the units that came again; most never do."""
        kept = [(u, c) for u, c in self.codes.items() if self.again[c]]
        if len(kept) > MEMORY_UNITS // 2:
            kept = []
        old = np.array([c for _, c in kept], np.int64)
        sizes = self.bounds[old + 1] - self.bounds[old]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        self.ids = self.ids[np.repeat(self.bounds[old] - upto[:-1], sizes) + np.arange(upto[-1])]
        self.bounds, self.again = upto, np.zeros(len(kept), bool)
        self.codes = {u: i for i, (u, _) in enumerate(kept)}

    def ids_of(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for run in byte_runs([_lowered(t) for t in texts], RUN_BYTES):
            yield from self._run(run)
            if len(self.again) > MEMORY_UNITS:
                self._forget()

    def _run(self, run: list[bytes]) -> Iterator[np.ndarray]:
        data = np.frombuffer(b"\n".join([*run, b""]), np.uint8)
        white = _WHITE[data]
        before = np.concatenate([[True], white[:-1]])
        starts, ends = np.flatnonzero(~white & before), np.flatnonzero(white & ~before)
        # Where a word's marks at its end begin; a word of more marks than that is not parted.
        solid, left = ends.copy(), np.arange(len(ends))
        for _ in range(MOST_MARKS + 1):
            left = left[(solid[left] > starts[left]) & _MARK[data[solid[left] - 1]]]
            solid[left] -= 1
        parted = (solid < ends) & (solid > starts) & _LETTER[data[solid - 1]]
        # A special token is a word's own matter.
        special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
        parted[left] = parted[np.searchsorted(starts, special, side="right") - 1] = False
        number = 1 + parted
        upto = np.concatenate([[0], np.cumsum(number)])
        begin, end, marks = np.repeat(starts, number), np.repeat(ends, number), upto[1:][parted] - 1
        begin[marks] = end[marks - 1] = solid[parted]
        bounds = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
        texts = upto[np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(t) + 1 for t in run])]))]
        units = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(data[~white])]).dictionary_encode()
        codes = self._known(units.dictionary.to_pylist())[units.indices.to_numpy()]
        sizes = self.bounds[codes + 1] - self.bounds[codes]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.bounds[codes] - upto[:-1], sizes) + np.arange(upto[-1])]
        for a, b in zip(upto[texts[:-1]].tolist(), upto[texts[1:]].tolist()):
            yield ids[a:b]


def _lowered(text: str | None) -> bytes:
    """The tokenizer lower-cases too, letter by letter. A text stays as it is if it has one of two letters that depend on what follows or
    become two, or the beginning of a special token, which counts only in lower case."""
    text = text or ""
    return (text if any(c in text for c in ("\u0130", "\u03a3", "<|")) else text.lower()).encode()


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of every piece."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if tokenizer_path not in _worker:
            _worker[tokenizer_path] = WordTokenizer(tokenizer_path)
        tokenizer, end = _worker[tokenizer_path], np.array([END_TOKEN], "<u4")
        for frame in batches:
            out = []
            for doc_id, ids in zip(frame["doc_id"].tolist(), tokenizer.ids_of(frame["text"].tolist())):
                ids = np.append(ids, end)
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    out.append((doc_id, start, len(part), zlib.crc32(part), len(ids)))
            yield pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    cut = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
        rows, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"
    )
    return cut.withColumn("doc_id", F.col("doc_id").cast("long"))


def _filling(left: np.ndarray, gap: int) -> list[int]:
    """Lengths that fill a gap: exactly with one or two pieces if possible, else the longest that fits, and so on."""
    chosen: list[int] = []
    left = left.copy()
    while gap > 0:
        if left[gap]:
            return [*chosen, gap]
        some = np.flatnonzero(left[:gap])
        if not len(some):
            return chosen
        pair = some[(left[gap - some] > (some == gap - some)) & (2 * some >= gap)]
        if len(pair):
            return [*chosen, int(pair[-1]), gap - int(pair[-1])]
        longest = int(some[-1])
        chosen.append(longest)
        left[longest] -= 1
        gap -= longest
    return chosen


def tier_of(length: int, window: int = WINDOW, tiers: tuple[int, ...] = ()) -> int:
    """The shortest tier that holds ``length`` tokens."""
    return min([t for t in tiers if length <= t < window], default=window)


def plan(counts: dict[int, int], window: int = WINDOW, tiers: tuple[int, ...] = ()) -> list[tuple[int, tuple[int, ...]]]:
    """(number of windows, their lengths in order), longest tier first, from how many pieces there are of each length.

    Without ``tiers`` all windows are of one size.
    """
    left = np.zeros(window + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    windows: Counter = Counter()
    sizes = sorted({window, *[t for t in tiers if t < window]}, reverse=True)
    # At last, what fills no window of its tier.
    for size, shorter in [*zip(sizes, [*sizes[1:], 0]), (window, 0)]:
        for length in range(size, shorter, -1):
            while left[length]:
                left[length] -= 1
                lengths = (length, *_filling(left, size - length))
                left[length] += 1
                if size < window and sum(lengths) < size:
                    break
                uses = Counter(lengths)
                number = min(int(left[k]) // n for k, n in uses.items())
                for k, n in uses.items():
                    left[k] -= n * number
                windows[lengths] += number
    return sorted(((n, w) for w, n in windows.items()), key=lambda x: (-tier_of(sum(x[1]), window, tiers), -sum(k * k for k in x[1]), x[1]))


def places(planned: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """By length: from which rank on pieces go to which run of windows and offset; rows (rank, first window, offset)."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: Counter = Counter()
    first = 0
    for number, lengths in planned:
        offset = 0
        for length in lengths:
            out.setdefault(length, []).append((used[length], first, offset))
            used[length] += number
            offset += length
        first += number
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, tiers: tuple[int, ...] = TIERS, step_sequences: int = STEP_SEQUENCES) -> DataFrame:
    """Every piece with its sequence, the offset and the tier there, and the step group.

    A step has about as many tokens as ``step_sequences`` windows of the longest tier.
    """
    cut = stored(pieces(docs, tokenizer_path, window), "pieces")
    # At most ``window`` rows come to the driver.
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    planned = plan(counts, window, tiers)
    found = places(planned)
    sizes: Counter = Counter()
    for number, lengths in planned:
        sizes[tier_of(sum(lengths), window, tiers)] += number
    steps = max(1, -(-sum(n * size for size, n in sizes.items()) // (window * step_sequences)))
    # Sequences are numbered tier by tier.
    tier_sizes, tier_ends = np.array([*sizes], np.int64), np.cumsum([*sizes.values()])
    tie = [F.col(c) for c in ("doc_id", "start", "ids_crc32", "doc_tokens")]
    bucket = F.substring(F.md5(F.concat_ws(":", F.col("doc_id"), F.col("start"))), 1, 2)
    numbered = ranked(cut.withColumn("_bucket", bucket), ["length"], "_bucket", tie, "_rank").drop("_bucket")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rank, length = frame.pop("_rank").to_numpy(), frame["length"].to_numpy()
            sequence, offset = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            order = np.argsort(length, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(part):
                    runs = found[int(length[part[0]])]
                    run = runs[np.searchsorted(runs[:, 0], rank[part], side="right") - 1]
                    sequence[part], offset[part] = run[:, 1] + rank[part] - run[:, 0], run[:, 2]
            tier = tier_sizes[np.searchsorted(tier_ends, sequence, side="right")]
            yield frame.assign(sequence_id=sequence, offset=offset, tier=tier, step_group=sequence % steps)

    named = numbered.select(F.col("doc_id").cast("string").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "_rank")
    schema = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
    return named.mapInPandas(rows, schema).withColumn("doc_id", F.col("doc_id").cast("long"))
