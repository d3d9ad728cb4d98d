"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pluvio.llm import importance
from pluvio.llm.common import on_workers
from tests.llm.helpers import documents, equals_sql, lowered, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, longest=1):
    words = WORD.findall(lowered(text))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain_draw(rows, target, percent, min_words, longest, buckets):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in rows:
        for f in plain_features(text, longest)[1]:
            s[bucket(f)] += 1
    for text in target:
        for f in plain_features(text, longest)[1]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1.0) * (sum(s) + buckets) / ((a + 1.0) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    scored = []
    for i, text in rows:
        words, features = plain_features(text, longest)
        weight = sum(gain[bucket(f)] for f in features)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append([i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, words])
    eligible = sorted((r for r in scored if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(eligible[: percent * len(eligible) // 100]):
        row[4] = place + 1
    return [tuple(r[:5]) for r in scored]


ROWS = [
    (1, prose(1, 40)), (2, prose(2, 40)), (3, "Target words " * 15), (4, "target WORDS and others " * 9), (5, None), (6, ""), (7, "few words"),
    (8, "..., ,;\n"), (9, "é ÄÄ x_y a1-2b İ " * 8), (10, "w" * 300_000 + " " + prose(3, 30)), (11, prose(4, 30_000)), (None, "target words " * 12),
    (12, "target words " * 12), (12, "target words " * 12), (12, prose(5, 24)), (13, prose(1, 40)), (14, " ".join("a" * n for n in range(1, 90))),
]
TARGET = ["target words of the benchmark", None, "", "Target words, again"]


@pytest.mark.parametrize(("percent", "min_words", "longest", "buckets"), [(10, 20, 1, 10_000), (60, 1, 3, 97), (100, 0, 2, 10_000)])
def test_draw_equals_plain_python(spark, percent, min_words, longest, buckets):
    docs = documents(spark, [(i, t, "s") for i, t in ROWS])
    target = spark.createDataFrame([(t, "x") for t in TARGET], "text string, doc_id string")
    run = on_workers(lambda spark: importance.draw(docs, target, percent, min_words, longest, buckets))
    found = run(spark)
    assert found.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    order = lambda r: tuple(str(v) for v in r)
    expected = plain_draw(ROWS, TARGET, percent, min_words, longest, buckets)
    assert sorted([tuple(r) for r in found.collect()], key=order) == sorted(expected, key=order)


def test_rows_alike_in_id_and_text_take_ranks_one_by_one(spark):
    docs = documents(spark, [(1, "same words " * 12, "s")] * 500 + [(i, prose(i, 25), "s") for i in range(2, 40)])
    target = spark.createDataFrame([("same words",)], "text string")
    found = on_workers(lambda spark: importance.draw(docs, target, 50))(spark).collect()
    assert sorted(r.rank for r in found if r.rank) == list(range(1, 538 // 2 + 1)) and len(found) == 538


def test_empty_tables(spark):
    none, some = documents(spark, []), documents(spark, [(1, prose(1, 30), "s"), (2, prose(2, 30), "s")])
    run = on_workers(lambda spark, d, t: importance.draw(d, t, 100))
    assert run(spark, none, some.select("text")).count() == 0
    assert {r.rank for r in run(spark, some, none.select("text")).collect()} == {1, 2}


def test_sample_keeps_the_rows_of_drawn_ids(spark):
    docs = documents(spark, [(i, prose(i, 25), "s") for i in range(20)])
    drawn = spark.createDataFrame([(3, 1), (7, 2), (8, None)], "doc_id long, rank long")
    found = importance.sample(docs, drawn)
    assert found.columns == docs.columns and {r.doc_id for r in found.collect()} == {3, 7}


def test_checksums_of_rows():
    values = [b"", b"a", b"123456789", b"x" * 63, b"x" * 64, b"y" * 200, b"b", b"987654321"]
    found = importance.crc32_values(pa.array(values, pa.binary()))
    assert found.tolist() == [zlib.crc32(v) for v in values] and found[2] == 0xCBF43926
    assert importance.crc32_values(pa.array(values, pa.binary())[2:5]).tolist() == [zlib.crc32(v) for v in values[2:5]]
    assert importance.crc32_rows(np.empty((0, 4), np.uint8)).tolist() == []


def test_query_equals_its_sql(spark):
    assert equals_sql(spark, "op11_importance")
