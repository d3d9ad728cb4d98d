"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from pluvio.llm import simhash
from pluvio.llm.common import on_workers
from tests.llm.helpers import documents, edited, lowered, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall(lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) << bit for bit in range(64))


def classes(values, links):
    """The smallest value reachable, by value."""
    top = {v: v for v in values}

    def find(v):
        while top[v] != v:
            top[v] = top[top[v]]
            v = top[v]
        return v

    for a, b in links:
        one, other = find(a), find(b)
        top[max(one, other)] = min(one, other)
    return {v: find(v) for v in values}


def near(values):
    values = list(values)
    return [(a, b) for i, a in enumerate(values) for b in values[:i] if bin(a ^ b).count("1") <= 3]


def cloud(seed, n, flips):
    """Fingerprints around a few centres: dense groups, chains of links and strangers."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(3)]
    found = {0, 2**64 - 1, *[rng.getrandbits(64) for _ in range(n // 4)]}
    while len(found) < n:
        value = rng.choice(centres)
        for bit in rng.sample(range(64), rng.randint(0, flips)):
            value ^= 1 << bit
        found.add(value)
    return sorted(found)


def frames(values, block, rows):
    """What tasks get, as one task's frames of so many rows."""
    parts = list(simhash_keys(values))
    table = pd.concat(parts, ignore_index=True)
    table["block"] = 0
    stands = table[table.own].groupby("key").size()
    out = []
    for key, part in table.groupby("key"):
        blocks = -(-int(stands.get(key, 0)) // block) or 1
        for _, row in part.iterrows():
            home = hash(row.fingerprint) % blocks
            out += [(key, b, row.fingerprint, bool(row.own) and b == home) for b in range(home if row.own else 0, blocks)]
    out.sort(key=lambda r: (r[0], r[1], not r[3]))
    table = pd.DataFrame(out, columns=["key", "block", "fingerprint", "own"])
    return [table[i : i + rows].reset_index(drop=True) for i in range(0, len(table), rows)]


def simhash_keys(values):
    values = np.array(values, np.uint64)
    for start in range(4):
        own = (simhash.turned(values, start) >> np.uint64(32)) | np.uint64(start << 32)
        yield pd.DataFrame({"key": own.view(np.int64), "fingerprint": values.view(np.int64), "own": True})
        for bit in range(16):
            seeks = (own >> np.uint64(bit)) & np.uint64(1) == 0
            yield pd.DataFrame({"key": (own[seeks] | np.uint64(1 << bit)).view(np.int64), "fingerprint": values[seeks].view(np.int64), "own": False})


@pytest.mark.parametrize(("flips", "block", "rows"), [(2, 4096, 4096), (3, 7, 50), (5, 4096, 33), (8, 5, 1000)])
def test_links_join_what_the_threshold_joins(flips, block, rows):
    values = cloud(flips, 220, flips)
    found = [pair for part in simhash._links(iter(frames(values, block, rows))) for pair in part]
    assert all(bin(a ^ b).count("1") <= 3 for a, b in found)
    assert classes(values, found) == classes(values, near(values))


def test_links_of_large_keys_in_blocks(spark):
    values = cloud(11, 300, 4)
    prints = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fingerprint long")
    run = on_workers(lambda spark, block: simhash.links(prints, block))
    for block in (6, 4096):
        found = [(r.a % 2**64, r.b % 2**64) for r in run(spark, block).collect()]
        assert classes(values, found) == classes(values, near(values))


def test_a_key_gives_a_spanning_set_of_links():
    values = np.array([1 << a | 1 << b for a in range(32) for b in range(a)], np.uint64)
    group, links = simhash._spanning(values, 2)
    assert len(links) == len(values) - len(set(group.tolist()))
    found = classes(values.tolist(), links)
    assert len({(g, found[v]) for g, v in zip(group.tolist(), values.tolist())}) == len(set(group.tolist())) == len(set(found.values()))
    key = simhash._Key((2 << 32, 0))
    key.stand(values)
    assert len(key.close()) == len(links) and len(key.seek(values[:50])) == 50 and key.close() == []


ROWS = [
    (5, prose(1, 200), "a"), (3, prose(1, 200).upper(), "a"), (9, edited(prose(1, 200), 190, "x"), "b"), (4, prose(2, 60), "a"),
    (7, None, "a"), (8, "", "a"), (6, " \t\n ", None), (10, "one", "a"), (11, "ONE", "a"), (12, "one two", "a"), (13, "one two three", "a"),
    (13, prose(3, 30), "a"), (13, prose(3, 30), "a"), (None, prose(1, 200), "a"), (14, prose(4, 30_000), "a"), (15, "é ü ß Ä ä", "a"),
    (16, "x" * 200_000, "a"), (17, "İ\x1c a\x85b", "a"),
]


def test_groups_equal_brute_force(spark):
    found = on_workers(lambda spark: simhash.simhash_groups(documents(spark, ROWS)))(spark).collect()
    prints = [(i, plain_fingerprint(t)) for i, t, _ in ROWS]
    top = classes({p for _, p in prints}, near({p for i, p in prints if i is not None}))
    least = {}
    for i, p in prints:
        if i is not None:
            least[top[p]] = min(least.get(top[p], i), i)
    expected = [(i, f"{p:016x}", None if i is None else least[top[p]]) for i, p in prints]
    order = lambda r: tuple(str(v) for v in r)
    assert sorted([tuple(r) for r in found], key=order) == sorted(expected, key=order)
    assert found[0].__fields__ == ["doc_id", "fingerprint", "component_id"]


def test_no_documents(spark):
    assert on_workers(lambda spark: simhash.simhash_groups(documents(spark, [])))(spark).count() == 0


def test_query_on_the_whole_table(spark):
    from pluvio.llm.registry import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    top = classes(set(prints.values()), near(set(prints.values())))
    least = {}
    for i, p in prints.items():
        least[top[p]] = min(least.get(top[p], i), i)
    found = {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op13_simhash"](spark, sf_dir).collect()}
    assert found == {(i, f"{p:016x}", least[top[p]]) for i, p in prints.items()}
