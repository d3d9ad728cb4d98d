"""Fill-in-the-middle against plain Python, with exact round trips."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pluvio.llm import fill_middle
from pluvio.llm.common import on_workers
from tests.llm.helpers import documents, equals_sql, prose

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain_cut(ident, text, seed=1, kept_plain=10, suffix_first=20):
    text = text or ""
    tokens = TOKEN.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - kept_plain:
        return ident, len(tokens), "plain", None, None, text
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    spm = h[3] % 100 < suffix_first
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return ident, len(tokens), "spm" if spm else "psm", len(prefix), len(middle), output


def mixed(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(["word", "x", " ", "\n", "é", "語", "😀", "1", "<", "<P", "S>", "\x00", "ab" * 40]) for _ in range(n))


ROWS = [
    *[(i, prose(i, 30 + i)) for i in range(40)], *[(100 + i, mixed(i, 5 * i)) for i in range(60)], (200, None), (201, ""), (202, "a <P> b"), (203, "<S>"),
    (204, "x<M>"), (205, "a" * 100_000), (206, "ab" * 50_000), (207, "語" * 40_000), (208, prose(9, 60_000)), (209, "."), (210, "a"),
    (211, "\r\n \x85 "), (None, "no id here"), (212, "twice the same"), (212, "twice the same"), (213, "<M" * 30), (214, "P>S>M>" * 30),
]


@pytest.mark.parametrize("shares", [(10, 20), (0, 50), (0, 100), (100, 20)])
def test_outputs_equal_plain_python_and_go_back(spark, shares):
    docs = documents(spark, [(i, t, "s") for i, t in ROWS])
    cut = on_workers(lambda spark: fill_middle.transform(docs, 1, *shares))(spark)
    assert cut.dtypes == [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"), ("output", "string")]
    found = cut.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    order = lambda r: tuple(str(v) for v in r)
    assert sorted([tuple(r)[:6] for r in found], key=order) == sorted([plain_cut(i, t, 1, *shares) for i, t in ROWS], key=order)
    assert sorted((str(r.doc_id), r.back) for r in found) == sorted((str(i), t or "") for i, t in ROWS)


def test_no_documents(spark):
    assert on_workers(lambda spark: fill_middle.transform(documents(spark, [])))(spark).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab Z.\né語😀"), max_size=2000), st.lists(st.integers(0, 8000), max_size=30))
def test_any_chunks_give_the_same_places(text, cuts):
    data = text.encode()
    cuts = sorted({c for c in cuts if 0 < c < len(data) and data[c] & 0xC0 != 0x80})
    chunked = fill_middle.Chunked(data, cuts, fill_middle.ChunkMemory())
    tokens = TOKEN.findall(text)
    assert chunked.n == len(tokens)
    for t in {0, len(tokens), *range(0, len(tokens), 7)}:
        before = "".join(tokens[:t])
        assert chunked.place(t) == (len(before.encode()), len(before))


def test_shared_passages_share_chunks():
    passage = prose(5, 4000).encode()
    memory = fill_middle.ChunkMemory()
    for head in (b"one start ", b"another, longer start here "):
        data = head + passage
        fill_middle.Chunked(data, fill_middle.cut_places(np.frombuffer(data, np.uint8)).tolist(), memory)
    assert memory.size < len(passage) * 1.2


def test_query_equals_its_sql(spark):
    assert equals_sql(spark, "op12_fill_middle")
