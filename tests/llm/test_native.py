"""Fingerprints, sharding and mixing: DataFrame functions only."""

import hashlib
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from pluvio.llm import fingerprints as fp, mixing, registry, sharding
from pluvio.llm.common import ranked

from .helpers import documents, prose, shingles

SF = "/root/testdata/sf0.001"
ODD = [(1, None, "a"), (2, "", "a"), (3, "one two", None), (4, "One  TWO\n", None), (5, prose(5, 3000), "b"), (6, prose(6, 40), "b"),
       (6, prose(6, 40), "b"), (7, "ä ö ü ß é", "a"), (None, "no id", "a"), (9, "\x1c x\xa0y", "c")]


@pytest.mark.parametrize("name", ["op7_fingerprints", "op8_sharding", "op9_mixing"])
def test_no_python_on_the_main_path(spark, plan, name):
    text = plan(registry.QUERIES[name](spark, SF))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_fingerprints_against_brute_force(spark):
    rows = {r.doc_id: r for r in registry.QUERIES["op7_fingerprints"](spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    order = sorted(texts, reverse=True)
    assert set(rows) == set(texts)
    by_text = {}
    for i, doc in enumerate(order):
        text, following = texts[doc] or "", texts[order[(i + 1) % len(order)]] or ""
        third = len(text) // 3
        other = text[: len(text) - third] + following[:third]
        r = rows[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(other.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        a, b, c = shingles(text), shingles(other), shingles(following)
        for near, x, y in ((r.near_edited, a, b), (r.near_next, a, c)):
            true = len(x & y) / len(x | y) if x | y else 1.0
            # Exact while the union fits the sketch, else within five standard deviations.
            assert abs(near - true) <= (1e-9 if len(x | y) <= fp.K else 5 * (0.25 / fp.K) ** 0.5)


def test_fingerprints_of_odd_rows(spark):
    rows = fp.fingerprints(documents(spark, ODD)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _, _ in ODD)
    empty = [r for r in rows if r.doc_id in (1, 2)]
    assert all(r.fingerprint == "" and r.n_chars == 0 for r in empty)
    one, two = (next(r.fingerprint for r in rows if r.doc_id == i) for i in (3, 4))
    assert one == two and len(one) == 16
    assert fp.fingerprints(documents(spark, [])).count() == 0
    alone = fp.fingerprints(documents(spark, [(1, "a b c d e f", "s")])).first()
    assert alone.near_next == 1.0


def test_next_row_crosses_pieces(spark):
    docs = documents(spark, [(i, f"t{i}", "s") for i in range(0, 200, 2)])
    got = {r.doc_id: r._next.text for r in fp.with_next(docs.select("doc_id", "text"), ["text"], piece_rows=7).collect()}
    assert got == {i: f"t{i - 2 if i else 198}" for i in range(0, 200, 2)}


def test_sketches_merge_and_estimate(spark):
    texts = [prose(1, 900), prose(1, 600), prose(2, 500)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string").withColumn("s", fp.sketch(F.col("text")))
    a, b, c = (r.s for r in df.orderBy("k").collect())
    both = spark.createDataFrame([(a, b, c)], "a array<bigint>, b array<bigint>, c array<bigint>")
    r = both.select(
        fp.merge(F.col("a"), F.col("c")).alias("merged"), fp.resemblance(F.col("a"), F.col("b")).alias("near"),
        fp.containment(F.col("b"), F.col("a")).alias("inside"), fp.distinct_shingles(F.col("a")).alias("distinct"),
        fp.containment(F.col("c"), F.col("a")).alias("apart"),
    ).first()
    assert r.merged == sorted(set(a) | set(c))[: fp.K]
    assert abs(r.near - 596 / 896) < 0.2 and r.inside > 0.8 and abs(r.distinct - 896) < 300 and r.apart == 0.0
    whole = fp.merge_all(df.withColumn("g", F.lit(1)), ["g"], "s").first().s
    assert whole == sorted(set(a) | set(b) | set(c))[: fp.K]


def law_of_rows(rows, shards):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes[k] for k in range(shards)) <= 1
    for k in range(shards):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sizes[k]))


def test_shards_are_even_and_mixed(spark):
    rows = registry.QUERIES["op8_sharding"](spark, SF).collect()
    texts = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    law_of_rows(rows, 8)
    assert {r.doc_id for r in rows} == set(texts) and all(r.law == "rows" and r.grown_shard is None for r in rows)
    for r in rows:
        data = (texts[r.doc_id].text or "").encode()
        assert r["size"] == len(data) + 1 and r.text_crc32 == zlib.crc32(data)
    by = Counter((r.source, r.shard) for r in rows)
    total = Counter(r.source for r in rows)
    # Ranks of a source are evenly spread, so each shard has its share within one row.
    assert all(abs(by[s, k] - n / 8) <= 1.01 for s, n in total.items() for k in range(8))


def test_sharding_of_odd_rows_is_repeatable(spark):
    docs = documents(spark, ODD + [(100 + k, "same", "hot") for k in range(300)])
    first, again = (sharding.shard(d, 7).collect() for d in (docs, docs.repartition(5)))
    law_of_rows(first, 7)
    assert sorted(map(str, first)) == sorted(map(str, again))
    assert sharding.shard(documents(spark, []), 4).count() == 0


def test_ranks_of_counted_pieces(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"), F.floor(F.col("id") / 100).alias("b"))
    got = ranked(df.withColumn("g", F.when(F.col("g") > 0, F.col("g"))), ["g"], "b", [F.col("v")], "rank").collect()
    for g in (None, 1, 2):
        assert [r["rank"] for r in sorted((r for r in got if r.g == g), key=lambda r: r.v)] == list(range(sum(r.g == g for r in got)))


def test_mixing_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    result = con.execute(registry.ORACLE["op9_mixing"])
    names = [d[0] for d in result.description]
    want = sorted(tuple(dict(zip(names, r)).items()) for r in map(tuple, result.fetchall()))
    got = [r.asDict() for r in registry.QUERIES["op9_mixing"](spark, SF).collect()]
    assert sorted(tuple((n, r[n]) for n in names) for r in got) == want
    by = Counter()
    for r in got:
        by[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"]
    largest = max(r["size"] for r in got)
    assert all(abs(by[r["source"]] - r["target"]) <= largest / 2 for r in got)


def test_water_filling(spark):
    sources = spark.createDataFrame([("a", 10, 3.0), ("b", 1000, 1.0), ("c", 1000, 2.0), (None, 0, 3.0)], "source string, source_size long, weight double")
    got = {r.source: r.target for r in mixing.water_fill(sources).collect()}
    # 3015 in all: a stands at its cap of 20, b and c share 2995 by 1 to 2 until c reaches its cap of 2000.
    assert got[None] == 0 and got["a"] == 20 and got["c"] == pytest.approx(2 * 2995 / 3) and got["b"] == pytest.approx(2995 / 3)


def test_mix_repeats_rows(spark):
    docs = documents(spark, ODD + [(100 + k, prose(k, 10), "hot") for k in range(40)])
    rows = mixing.sized(docs)
    plan = {r.source: r for r in mixing.plan_mixture(rows).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter(r.doc_id for r in mixed.collect())
    again = Counter(r.doc_id for r in mixing.mix(docs.repartition(3)).collect())
    assert got == again and max(got[100 + k] for k in range(40)) <= 2
    assert abs(10 * sum(got[100 + k] for k in range(40)) - plan["hot"].target) <= 5
    assert mixing.mix(documents(spark, [])).count() == 0
