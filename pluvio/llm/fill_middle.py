"""Fill-in-the-middle: a document cut in prefix, middle and suffix at token bounds that its id fixes, and put together anew.

Tokens are runs of letters and single other characters. Texts are not matched token by token: a rolling hash cuts
them into chunks where the content says so, so that texts that share a passage share most of its chunks. What counts of a chunk is a
summary of its bounds and insides: how many tokens and characters it holds, and whether it begins and ends within letters.
Summaries are kept by content (a look-up compares the bytes, so no two chunks are mistaken for one another). The
tokens up to a chunk's end follow by adding counts, less one where letters run on over the border between two chunks; so a cut is found
by its chunk, and only that chunk is looked into.

An output is ``plain`` (the text) or holds the parts behind marks: ``psm`` has prefix, suffix, middle, ``spm`` suffix,
prefix, middle. ``restored`` rebuilds the exact text from output and form alone: a text that contains a mark stays plain,
and no mark can arise where a part meets a mark, as none ends as it begins.

A null text counts as empty and is plain. Repeated rows are cut each, alike for the same id; a null id is cut as an empty one. Very long
texts are taken whole, chunk by chunk. Columns besides doc_id and text are passed over; no documents, no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pluvio.llm.common import byte_runs

SEED, KEPT_PLAIN, SUFFIX_FIRST = 1, 10, 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
# Bytes of a chunk: at least, about, and at most; and how many bytes of chunks a worker remembers.
LEAST, ABOUT, MOST = 128, 512, 8192
MEMORY_BYTES = 32 << 20

# One pseudorandom value a byte, from a multiplicative rule.
_GEAR = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)
_GEAR ^= _GEAR >> np.uint32(15)
_GEAR *= np.uint32(0x2C1B3C6D)
# Letters, other characters by their first byte, and bytes that only continue a character.
_CONTINUES = bytes(range(0x80, 0xC0))
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_KINDS = bytes(ord("a") if _LETTER[b] else ord(".") for b in range(256))


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places before which the rolling hash of the last 16 bytes asks for a cut; never inside a character."""
    rolled = _GEAR[data]
    for step in (1, 2, 4, 8):
        rolled[step:] = rolled[step:] + (rolled[:-step] << np.uint32(step))
    places = np.flatnonzero((rolled >> np.uint32(16)) % np.uint32(ABOUT) == 0) + 1
    places = places[places < len(data)]
    return places[(data[places] & 0xC0) != 0x80]


class ChunkMemory:
    """Summaries of chunks by their content."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, int, bool, bool]] = {}
        self.size = 0

    def summary(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        """Tokens, characters, and whether the chunk begins and ends with a letter."""
        found = self.known.get(chunk)
        if found is None:
            kinds = chunk.translate(_KINDS, _CONTINUES)
            begins, ends = kinds[:1] == b"a", kinds[-1:] == b"a"
            found = kinds.count(b".") + kinds.count(b".a") + begins, len(kinds), begins, ends
            if self.size > MEMORY_BYTES:
                self.known, self.size = {}, 0
            self.known[chunk] = found
            self.size += len(chunk)
        return found


class Chunked:
    """A text by its chunks."""

    def __init__(self, data: bytes, cuts: Sequence[int], memory: ChunkMemory):
        """``cuts`` are the places, within the text, that the rolling hash asks for."""
        self.data, self.starts, self.tokens, self.chars = data, [0], [0], [0]
        self.runs_on: list[bool] = []
        at, letter = 0, False
        while at < len(data):
            k = bisect_left(cuts, at + LEAST)
            end = min(cuts[k] if k < len(cuts) else len(data), len(data))
            if end > at + MOST:
                end = at + MOST
                while data[end] & 0xC0 == 0x80:
                    end -= 1
            tokens, chars, begins, ends = memory.summary(data[at:end])
            self.runs_on.append(letter and begins)
            self.tokens.append(self.tokens[-1] + tokens - (letter and begins))
            self.chars.append(self.chars[-1] + chars)
            self.starts.append(end)
            at, letter = end, ends
        self.n = self.tokens[-1]

    def place(self, tokens: int) -> tuple[int, int]:
        """Bytes and characters before the token of that number."""
        if tokens == 0 or tokens == self.n:
            return (0, 0) if tokens == 0 else (len(self.data), self.chars[-1])
        # The last chunk that begins with at most so many tokens before it, and in which the token begins.
        k = bisect_left(self.tokens, tokens + 1) - 1
        chunk = self.data[self.starts[k] : self.starts[k + 1]]
        codes = np.frombuffer(chunk, np.uint8)
        letter = _LETTER[codes]
        follows = letter.copy()
        follows[0], follows[1:] = False, letter[1:] & letter[:-1]
        begins = np.flatnonzero(((codes & 0xC0) != 0x80) & ~follows)
        offset = int(begins[tokens - self.tokens[k] + self.runs_on[k]])
        return self.starts[k] + offset, self.chars[k] + len(chunk[:offset].translate(None, _CONTINUES))


def _cut(ident: str | None, text: Chunked, seed: int, kept_plain: int, suffix_first: int) -> tuple:
    """n, form, characters of prefix and middle, output."""
    data, n = text.data, text.n
    digest = hashlib.sha256(f"{seed}:{ident or ''}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not data or h3 % 100 >= 100 - kept_plain or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, data
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_chars), (b, b_chars) = text.place(first), text.place(second)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if h4 % 100 < suffix_first:
        form, output = "spm", b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    else:
        form, output = "psm", b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return n, form, a_chars, b_chars - a_chars, output


def transform(docs: DataFrame, seed: int = SEED, kept_plain: int = KEPT_PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars (null if plain) and output of every row.

    ``kept_plain`` and ``suffix_first`` are percentages, of all documents and of those cut.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = ChunkMemory()
        for frame in batches:
            out, ids = [], iter(frame["doc_id"].tolist())
            for run in byte_runs(frame["text"].tolist()):
                cuts = cut_places(np.frombuffer(b"".join(run), np.uint8)) if any(run) else np.empty(0, np.int64)
                at = 0
                for data in run:
                    own = cuts[np.searchsorted(cuts, at, side="right") : np.searchsorted(cuts, at + len(data))] - at
                    ident = next(ids)
                    out.append((ident, *_cut(ident, Chunked(data, own.tolist(), memory), seed, kept_plain, suffix_first)))
                    at += len(data)
            result = pd.DataFrame(out, columns=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
            yield result.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    cut = read.mapInPandas(rows, "doc_id string, n long, form string, prefix_chars long, middle_chars long, output binary")
    return cut.withColumns({"doc_id": F.col("doc_id").cast("long"), "output": F.col("output").cast("string")})


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from."""
    first, second, third = PREFIX.decode(), SUFFIX.decode(), MIDDLE.decode()

    def parts(one: str, other: str) -> tuple[Column, Column, Column]:
        """What stands between the marks ``one``, ``other`` and the middle's, and behind that."""
        a, b = F.instr(output, F.lit(other)), F.instr(output, F.lit(third))
        return (
            F.substring(output, F.lit(len(one) + 1), a - len(one) - 1),
            F.substring(output, a + len(other), b - a - len(other)),
            F.substring(output, b + len(third), F.length(output)),
        )

    prefix, suffix, middle = parts(first, second)
    suffix_, prefix_, middle_ = parts(second, first)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(prefix_, middle_, suffix_))
    )
