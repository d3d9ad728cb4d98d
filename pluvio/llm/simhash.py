"""SimHash near-duplicates: documents whose 64-bit fingerprints differ in few bits, and the groups they form.

A fingerprint's bit is the majority of that bit over the XXH64 hashes of the text's three-word shingles, repeats included.
Equal fingerprints are one, with the smallest of their ids, before anything is compared.

Candidates come from pigeonring filtering. The fingerprint is a ring of four segments of 16 bits. If two fingerprints
differ in at most 3 bits there is a segment to start from such that every chain of consecutive segments from
there stays within its share of the budget: no difference in the first, at most 1 in the first two, at most 2 in the first three, at
most 3 in all. The first two steps of the chain are an equal key of 34 bits (start, first segment, second
segment): every fingerprint stands under its own key, and seeks under the keys in which one 0 of the second
segment is 1; of two fingerprints that differ there the one with the 0 finds the other. What meets under a key goes through the third step, and only
the survivors through the full check.

Rows are dealt by key and sorted, and a task takes them as a stream, key by key: it holds the fingerprints that stand under
the key and passes the others by them. It gives out no pairs but a spanning set of links: those that join what stands
there (found from one to all not yet reached, so a dense group costs few rounds), and for any other one link to each
group it reaches. A key under which more than ``BLOCK`` stand is cut in blocks by hash, each a key of its own to which all others come too.

A null or empty text has fingerprint zero, and links like any other. Rows of a null id get their fingerprint but take no part
in groups; their group is null. Repeated rows and ids are one node if their fingerprints agree, and several (with the same id) else.
Very long texts are hashed whole, piece by piece. Columns besides doc_id and text are passed over; no documents, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from pluvio.llm.common import stored
from pluvio.llm.components import components
from pluvio.operators.joins import small_side

WORDS, SEED, BITS = 3, 42, 3
SEGMENTS, WIDTH = 4, 16
# Fingerprints that stand under one key of a task, hashes counted at a time, and rows of keys that a task works on at a time.
BLOCK, COUNTED, HELD_ROWS = 4096, 1 << 16, 1 << 16
_U = np.uint64


def fingerprint(text: bytes) -> int:
    """The majority bits of the hashes of the text's shingles; without words zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined, lengths = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(WORDS, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    one, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), COUNTED):
        a, b = starts[at : at + COUNTED].tolist(), ends[at : at + COUNTED].tolist()
        hashes = np.fromiter([one(joined[i:j], SEED) for i, j in zip(a, b)], "<u8", len(a))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (as a signed 64-bit number) of every row."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            found = np.array([fingerprint(t or b"") for t in frame["text"]], _U).view(np.int64)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "fingerprint": found})

    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return read.mapInPandas(rows, "doc_id string, fingerprint long").withColumn("doc_id", F.col("doc_id").cast("long"))


def turned(values: np.ndarray, start: int) -> np.ndarray:
    """The ring from segment ``start`` on, its first segment highest."""
    by = _U(start * WIDTH)
    return values if not start else (values << by) | (values >> (_U(64) - by))


def within_chain(a: np.ndarray, b: np.ndarray, start: int) -> np.ndarray:
    """Of pairs that meet under a key of ``start``: whether chains of three and of all four segments stay within their budgets."""
    differ = turned(a ^ b, start)
    near = np.bitwise_count(differ >> _U(WIDTH)) <= BITS * 3 // SEGMENTS
    # The full check of the survivors.
    near[near] = np.bitwise_count(differ[near]) <= BITS
    return near


def keys(prints: DataFrame) -> DataFrame:
    """(key, fingerprint, own): every fingerprint under its own key of each start and, from there, under the keys that it seeks."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            values = frame["fingerprint"].to_numpy().view(_U)
            for start in range(SEGMENTS):
                own = (turned(values, start) >> _U(32)) | _U(start << 32)
                yield pd.DataFrame({"key": own.view(np.int64), "fingerprint": values.view(np.int64), "own": True})
                for bit in range(WIDTH):
                    seeks = (own >> _U(bit)) & _U(1) == 0
                    if seeks.any():
                        sought = (own[seeks] | _U(1 << bit)).view(np.int64)
                        yield pd.DataFrame({"key": sought, "fingerprint": values[seeks].view(np.int64), "own": False})

    return prints.select("fingerprint").mapInPandas(rows, "key long, fingerprint long, own boolean")


def _dealt(prints: DataFrame, block: int) -> DataFrame:
    """``keys`` with their block; of a key with more fingerprints than ``block`` those that stand there also come to the later blocks, as seekers."""
    rows = keys(prints)
    many = rows.filter("own").groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block)
    many = stored(many, "large-keys")
    rows = rows.withColumn("block", F.lit(0))
    if many.isEmpty():
        return rows
    of = rows.drop("block").join(small_side(many), F.col("key") == F.col("_key"), "left")
    blocks = F.coalesce(F.ceil(F.col("_n") / block), F.lit(1)).cast("int")
    home = F.pmod(F.xxhash64("fingerprint"), blocks).cast("int")
    spread = of.withColumn("_home", home).select("key", "fingerprint", "own", "_home", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    # Of two blocks of one key either would compare their members: the earlier one seeks in the later.
    spread = spread.filter("not own or block >= _home")
    return spread.select("key", "fingerprint", (F.col("own") & (F.col("block") == F.col("_home"))).alias("own"), "block")


def _spanning(standing: np.ndarray, start: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Groups of what stands under a key (numbers), and links that join them."""
    group, links = np.full(len(standing), -1), []
    rest = np.arange(len(standing))
    number = 0
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        group[frontier[0]] = number
        while frontier and len(rest):
            at = frontier.pop()
            near = within_chain(standing[at], standing[rest], start)
            found, rest = rest[near], rest[~near]
            group[found] = number
            links += [(int(standing[at]), int(standing[j])) for j in found]
            frontier.extend(found.tolist())
        number += 1
    return group, links


class _Key:
    """The key that a task is at: what stands under it, and the links found there."""

    def __init__(self, name: tuple[int, int]):
        self.name, self.start, self.standing, self.group = name, name[0] >> 32, np.empty(0, _U), None

    def stand(self, values: np.ndarray) -> None:
        self.standing = np.concatenate([self.standing, values])

    def close(self) -> list[tuple[int, int]]:
        """Links of what stands here, once no more of it can come."""
        if self.group is not None:
            return []
        self.group, found = _spanning(self.standing, self.start)
        return found

    def seek(self, values: np.ndarray) -> list[tuple[int, int]]:
        """One link of each value to each group that it reaches."""
        found, n = [], len(self.standing)
        size = max(1, (HELD_ROWS << 4) // max(1, n))
        for at in range(0, len(values) if n else 0, size):
            part = values[at : at + size]
            i, j = np.divmod(np.flatnonzero(within_chain(np.repeat(part, n), np.tile(self.standing, len(part)), self.start)), n)
            _, once = np.unique(i * n + self.group[j], return_index=True)
            found += zip(part[i[once]].tolist(), self.standing[j[once]].tolist())
        return found


def _single(key: np.ndarray, values: np.ndarray, bounds: np.ndarray, which: np.ndarray) -> list[tuple[int, int]]:
    """Links under the keys ``which``, where the first row of each stands and all others seek: all at once."""
    seekers = np.diff(bounds)[which] - 1
    upto = np.concatenate([[0], np.cumsum(seekers)])
    at = np.repeat(bounds[which] + 1 - upto[:-1], seekers) + np.arange(upto[-1])
    one, other, starts = np.repeat(values[bounds[which]], seekers), values[at], np.repeat(key[bounds[which]] >> 32, seekers)
    found: list[tuple[int, int]] = []
    for start in range(SEGMENTS):
        a, b = one[starts == start], other[starts == start]
        near = within_chain(a, b, start)
        found += zip(a[near].tolist(), b[near].tolist())
    return found


def _links(frames: Iterator[pd.DataFrame]) -> Iterator[list[tuple[int, int]]]:
    """Links within frames of rows sorted by key, block and standing rows first. A key may go on from frame to frame."""
    current: _Key | None = None
    for frame in frames:
        key, block = frame["key"].to_numpy(), frame["block"].to_numpy()
        values, own = frame["fingerprint"].to_numpy().view(_U), frame["own"].to_numpy()
        bounds = np.concatenate([[0], np.flatnonzero((np.diff(key) != 0) | (np.diff(block) != 0)) + 1, [len(key)]])
        sizes, standing = np.diff(bounds), np.add.reduceat(own.astype(np.int64), bounds[:-1])
        inner = np.ones(len(sizes), bool)
        inner[[0, -1]] = False
        out = _single(key, values, bounds, np.flatnonzero(inner & (standing == 1) & (sizes > 1)))
        for g in np.flatnonzero(~inner | (standing > 1)).tolist():
            a, b = bounds[g], bounds[g + 1]
            name, mine, stands = (int(key[a]), int(block[a])), values[a:b], own[a:b]
            if current is None or current.name != name:
                out += current.close() if current is not None else []
                current = _Key(name)
            current.stand(mine[stands])
            # Seekers come after all that stand; the last key of the frame may go on in the next.
            if not stands.all():
                out += current.close()
                out += current.seek(mine[~stands])
        yield out
    if current is not None:
        yield current.close()


def links(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints that join all that the threshold joins."""

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, size = [], 0
        for frame in batches:
            part.append(frame)
            size += len(frame)
            if size >= HELD_ROWS:
                yield pd.concat(part, ignore_index=True)
                part, size = [], 0
        if size:
            yield pd.concat(part, ignore_index=True)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for found in _links(runs(b for b in batches if len(b))):
            if found:
                pairs = np.array(found, _U).view(np.int64)
                yield pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})

    order = [F.col("key"), F.col("block"), F.col("own").desc()]
    dealt = _dealt(prints, block).repartition("key", "block").sortWithinPartitions(*order)
    return dealt.mapInPandas(rows, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable by links, of every row."""
    rows = stored(fingerprints(docs), "fingerprints")
    named = rows.filter("doc_id is not null").groupBy("fingerprint")
    prints = stored(named.agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")), "distinct-fingerprints")
    labels = components(links(prints, block))
    of = prints.join(labels, prints["fingerprint"] == labels["node"], "left").withColumn("label", F.coalesce("label", "fingerprint"))
    several = stored(of.filter("node is not null or rows > 1").select("fingerprint", "label", "least"), "several")
    of_group = several.groupBy(F.col("label").alias("_label")).agg(F.min("least").alias("component"))
    found = several.join(of_group, F.col("label") == F.col("_label")).select(F.col("fingerprint").alias("_fingerprint"), "component")
    joined = rows.join(small_side(stored(found, "groups")), F.col("fingerprint") == F.col("_fingerprint"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), component.alias("component_id"))
