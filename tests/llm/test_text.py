"""N-gram join, line dedup, packing and the classifiers."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import line_dedup, ngram_join, packing, quality, registry, toxicity
from pluvio.llm.components import components
from pluvio.llm.words import shingle_sets, word_hashes

from .helpers import WORD, documents, edited, groups, lowered, prose, shingles

SF = "/root/testdata/sf0.001"
SF_LABELS = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    yield con
    con.close()


# --- words and shingles ------------------------------------------------------------------------


def test_shingle_counts_are_exact():
    texts = [None, "", " \t\n\x0b\x0c\r ", "one", "One one ONE one", "a b c d e", "a b c d e a b c d e a b c d e", prose(1, 700),
             "Ä b\xa0c d\x85e f g h i j", "x " * 5000, "\x1c a"]
    assert [len(s) for s in shingle_sets(texts)] == [len(shingles(t)) for t in texts]
    run = [t.encode() for t in texts if t]
    hashes, bounds = word_hashes(run)
    words = [w for t in texts if t for w in WORD.findall(lowered(t))]
    assert len(hashes) == len(words) == bounds[-1]
    assert len(set(hashes.tolist())) == len(set(words)) and dict(zip(words, hashes.tolist())) == dict(zip(words, hashes.tolist()))


def test_order_of_words_and_letters_counts():
    a, b, c, d = shingle_sets(["a b c d e", "b a c d e", "ab cd", "ba cd"])
    assert len({int(x[0]) for x in (a, b, c, d)}) == 4


# --- n-gram join -------------------------------------------------------------------------------


def joined(docs, **options):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_groups(docs, **options).collect()}


def test_groups_on_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert joined(docs) == groups([(r.doc_id, r.text) for r in docs.collect()])


def test_planted_groups(spark):
    base = prose(1, 120)
    passage = prose(99, 60)
    rows = [(k, base, "s") for k in range(40)]  # exact copies
    rows += [(100 + k, edited(base, 20 + k, f"e{k}x"), "s") for k in range(40)]  # near copies of differing strength
    rows += [(200 + k, edited(edited(base, 40, "chain"), 60 - k, f"f{k}x"), "s") for k in range(10)]  # copies of a copy
    rows += [(300 + k, f"{passage} {prose(500 + k, 25 + k)}", "s") for k in range(30)]  # a passage that many share
    rows += [(400, "tiny text", "s"), (401, "Tiny  TEXT", "s"), (402, "tiny", "s"), (403, None, "s"), (404, "", "s"), (405, "", "s")]
    rows += [(500, prose(7, 80), "s"), (501, prose(7, 60), "s"), (502, prose(7, 61), "s"), (503, prose(8, 20000), "s")]
    rows = [rows[i] for i in np.random.default_rng(3).permutation(len(rows))]
    assert joined(documents(spark, rows)) == groups([(i, t) for i, t, _ in rows])


@pytest.mark.parametrize("seed", range(3))
def test_random_groups(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(12):
        words = prose(1000 * seed + g, int(rng.integers(5, 90))).split()
        for _ in range(int(rng.integers(1, 14))):
            own = [f"r{rng.integers(10**9)}" if rng.random() < 0.04 else w for w in words[: len(words) - int(rng.integers(0, 12))]]
            rows.append((len(rows), " ".join(own), "s"))
    assert joined(documents(spark, rows)) == groups([(i, t) for i, t, _ in rows])


def test_thresholds_are_exact_at_the_bound(spark):
    # 7 + k words give 3 + k shingles: 3 of 4 are exactly the threshold, 5 of 7 are below it.
    rows = [(1, "a b c d e f g", "s"), (2, "a b c d e f g h", "s"), (10, " ".join(map(str, range(9))), "s"), (11, " ".join(map(str, range(11))), "s")]
    assert joined(documents(spark, rows)) == {(1, 3, 1), (2, 4, 1), (10, 5, 10), (11, 7, 11)}


def test_odd_rows_of_the_join(spark):
    twice = [(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (None, "a b c d e f", "s"), (2, "a b c d e f", "s")]
    assert joined(documents(spark, twice)) == {(1, 2, 1), (2, 2, 1), (None, 2, None)}
    assert joined(documents(spark, [])) == set()
    assert joined(documents(spark, [(5, None, None)])) == {(5, 0, 5)}


def test_packed_columns_round_trip():
    values = np.array([0, 1, 2**47, 2**48 - 1], np.uint64)
    assert (ngram_join.unpack(ngram_join.pack(values, 6), 6) == values).all()
    for n in range(1, 300):
        q, k = ngram_join.first_columns(n), ngram_join.spare_columns(n)
        assert 1 <= q <= n and q + k <= n + 1 and ngram_join.needed(n, n) >= ngram_join.least_overlap(n)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(f"{k:03d}", f"{k + 1:03d}") for k in range(60)] + [("x", "y"), ("y", "x"), ("z", "z")], "a string, b string")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {f"{k:03d}": "000" for k in range(61)} | {"x": "x", "y": "x"}


# --- line dedup --------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op2_ngram_join", "op3_line_dedup"])
def test_query_equals_its_sql(spark, duck, name):
    result = duck.execute(registry.ORACLE[name])
    names = [d[0] for d in result.description]
    got = registry.QUERIES[name](spark, SF).select(names).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, result.fetchall()))


def stripped(rows, ratio, least):
    """The definition, row by row."""
    pages, holds = defaultdict(set), defaultdict(set)
    for _, text, site in rows:
        if text is not None:
            pages[site].add(text)
            for line in text.split("\n"):
                holds[site, line.strip(" \t\n\x0b\x0c\r")].add(text)
    bad = {k for k, p in holds.items() if k[1] and len(p) >= least and len(p) > ratio * len(pages[k[0]])}
    return sorted(
        (str(i), None if t is None else "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\n\x0b\x0c\r")) not in bad), s or "") for i, t, s in rows
    )


def test_line_dedup_rules(spark):
    rows = [(k, f"Menu\n  own line {k}\n\nAll rights reserved\r\nrare {k // 4}", "hot") for k in range(60)]
    rows += [(100 + k, "copied page\nof many lines", "hot") for k in range(50)]  # copies count once
    rows += [(200 + k, f"Menu\nx{k}", "small") for k in range(4)] + [(300, None, "hot"), (301, "", "hot"), (302, "Menu", None), (303, "\n\n", "hot")]
    rows += [(0, "Menu\nagain", "hot"), (None, "Menu", "hot")]
    docs = documents(spark, rows)
    got = line_dedup.drop_lines(docs, ratio=0.2, min_pages=5)
    assert got.columns == [*docs.columns, "_lines", "_dropped"]
    out = got.collect()
    assert sorted((str(r.doc_id), r.text, r.source or "") for r in out) == stripped(rows, 0.2, 5)
    one = next(r for r in out if r.doc_id == 5)
    assert (one.text, one._lines, one._dropped) == ("  own line 5\n\nrare 1", 5, 2)
    assert next(r for r in out if r.doc_id == 120).text == "copied page\nof many lines"
    assert line_dedup.drop_lines(documents(spark, [])).count() == 0


def near_copies(size):
    """Copies of a text, two thirds with a word changed and the others with too many to be linked, from few words."""
    rng, base, words = np.random.default_rng(size), prose(77, 140).split(), prose(78, 30).split()
    rows = []
    for i in range(size):
        text = list(base)
        for at in rng.choice(len(text), 1 if i % 3 else rng.integers(4, 9), replace=False):
            text[at] = words[rng.integers(len(words))]
        rows.append((i, " ".join(text)))
    return rows


def test_copies_apart_from_their_hub_propose_few_pairs(spark, monkeypatch):
    proposed = {}
    whole = ngram_join.outside_pairs

    def counted(*args):
        pairs = whole(*args)
        proposed[size] = pairs.count()
        return pairs

    monkeypatch.setattr(ngram_join, "outside_pairs", counted)
    size = 240
    rows = near_copies(size)
    assert joined(documents(spark, [(i, t, "s") for i, t in rows])) == groups(rows)
    # Every one apart with every other of the group would be 80 x 239.
    assert proposed[size] <= 4 * size


# --- packing -----------------------------------------------------------------------------------


def check_packing(spark, rows, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(registry.tokenizer_path())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in texts.items():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            part = ids[r.start : r.start + r.length]
            assert r.start == at and r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids) and len(part) == r.length
            at += r.length
        assert at == len(ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / sum(r.length for r in rows)


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = registry.QUERIES["op5_packing"](spark, SF).collect()
    padding = check_packing(spark, rows, {r.doc_id: r.text for r in docs.collect()})
    assert padding < 0.02
    assert sorted({r.sequence_id for r in rows}) == list(range(len({r.sequence_id for r in rows})))
    steps = defaultdict(int)
    for r in rows:
        steps[r.step_group] += r.length**2
    assert max(steps.values()) < 1.3 * min(steps.values())


def test_packing_of_odd_rows(spark):
    texts = {1: None, 2: "", 3: "don't stop!! it's <|endoftext|>ok<|startoftext|> é ́x İstanbul ΣΑΣ σς ﬁ ẞ 12ab a\xa0b c \x1c'll",
             4: "word " * 5000, 5: "x" * 30000, 6: "日本語 テスト. привет, мир.", 7: "..,, a.b a,b. $$$ a$$$"}
    rows = packing.pack(documents(spark, [(i, t, "s") for i, t in texts.items()]), registry.tokenizer_path()).collect()
    check_packing(spark, rows, texts)
    again = packing.pack(documents(spark, [(1, "same text", "s")] * 9 + [(None, "no id", None)]), registry.tokenizer_path()).collect()
    assert Counter(r.doc_id for r in again) == {1: 9, None: 1} and len({(r.sequence_id, r.offset) for r in again}) == 10
    assert packing.pack(documents(spark, []), registry.tokenizer_path()).count() == 0


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(0)
    counts = Counter(int(x) for x in rng.integers(1, 2049, 5000)) + Counter({2048: 700, 3: 900})
    planned = packing.plan(dict(counts))
    used = Counter()
    for n, lengths in planned:
        assert sum(lengths) <= 2048 and n > 0
        for k in lengths:
            used[k] += n
    assert used == counts
    full = sum(n * 2048 for n, _ in planned)
    assert sum(k * n for k, n in counts.items()) / full > 0.995


def test_windows_of_every_tier(spark):
    """A tier has windows of its own size; gaps of longer ones are filled from shorter tiers; steps share each tier evenly."""
    rng = np.random.default_rng(4)
    counts = Counter(int(x) for x in rng.integers(1, 2049, 3000)) + Counter(int(x) for x in rng.integers(1, 400, 6000))
    planned = packing.plan(dict(counts), 2048, packing.TIERS)
    used, sizes = Counter(), []
    for n, lengths in planned:
        size = packing.tier_of(sum(lengths), 2048, packing.TIERS)
        sizes.append((size, n))
        used.update({k: n * lengths.count(k) for k in set(lengths)})
        if size > 256 and lengths[0] > size // 2:
            assert all(k <= size // 2 for k in lengths[1:])
    assert used == counts and {s for s, _ in sizes} == set(packing.TIERS) and [s for s, _ in sizes] == sorted((s for s, _ in sizes), reverse=True)
    assert sum(s * n for s, n in sizes) < 1.001 * sum(k * n for k, n in counts.items())
    texts = [" ".join(["word"] * (k - 1)) for k in (2048, 1500, 548, 1000, 24, 400, 112, 200, 56, 50)]
    rows = packing.pack(documents(spark, [(k, t, "s") for k, t in enumerate(texts)]), registry.tokenizer_path(), step_sequences=1).collect()
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id, r.tier].append(r.length)
    assert sorted((tier, sorted(v)) for (_, tier), v in held.items()) == [
        (256, [50]), (256, [56, 200]), (512, [112, 400]), (1024, [24, 1000]), (2048, [548, 1500]), (2048, [2048])]
    assert {r.step_group for r in rows} == {0, 1, 2}


def test_exact_fillings():
    left = np.zeros(2049, np.int64)
    left[[100, 300, 700]] = [1, 2, 1]
    assert packing._filling(left, 700) == [700] and sorted(packing._filling(left, 600)) == [300, 300]
    assert sorted(packing._filling(left, 400)) == [100, 300] and packing._filling(left, 250) == [100] and packing._filling(left, 50) == []


# --- classifiers -------------------------------------------------------------------------------


def accuracy(spark, name, label):
    rows = registry.QUERIES[name](spark, SF_LABELS).join(spark.read.parquet(f"{SF_LABELS}/labels.parquet"), "doc_id").collect()
    fold = {"toxic": (4, 2), "quality": (3, 1)}[label]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1]) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    return sum(r.predicted == r[label] for r in held) / len(held)


def test_quality_on_held_out_labels(spark):
    assert accuracy(spark, "op1_quality", "quality") > 0.95


def test_toxicity_on_held_out_labels(spark):
    # 37 toxic examples: words of the smaller languages are seen too seldom to be learned.
    assert accuracy(spark, "op10_toxicity", "toxic") > 0.9


def marked(n, toxic_every):
    return [(k, f"{prose(k, 30)} {'vile' if k % toxic_every == 0 else 'kind'}", "s") for k in range(n)]


def test_toxic_words_are_learned_from_positives_and_unlabelled(spark):
    docs = documents(spark, marked(300, 5))
    labels = spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(0, 150)] + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    score = dict(zip("abcde", model.scores(["Vile!", "kind words", "", None, "so vilely"])))
    assert score["a"] > 0.5 and score["b"] < 0.3 and score["c"] == score["d"] < 0.3 and score["e"] >= 0.3
    assert model.scores([]).shape == (0,)


def test_a_repeated_id_is_one_example(spark, monkeypatch):
    docs = documents(spark, marked(40, 4) + [(k, f"vile text {k} {j} {prose(j, 9)}", "s") for k in (4, 5) for j in range(60)])
    labels = spark.createDataFrame([(k, k % 2, int(k % 4 == 0)) for k in range(40)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(x)))
    monkeypatch.setattr(toxicity, "fit", lambda rows, *rest: seen.append(len(rows)))
    quality.train(docs, labels)
    toxicity.train(docs, labels)
    assert seen == [40, 50]


def test_negative_risk_turns_the_gradient():
    # Every unlabelled text is toxic: without the correction the second term would run away below zero.
    model = toxicity.fit([np.array([0])] * 8, np.array([1, 1, 1, 1, 0, 0, 0, 0]), np.array([5], np.uint64), prior=0.4)
    assert np.isfinite(model.weights).all() and abs(model.intercept) < 20


def test_classifiers_without_labels_or_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = documents(spark, [(1, "a b", "s"), (None, None, None)])
    assert all(r.s < 1e-9 for r in toxicity.scored(docs, toxicity.train(docs, labels), "s").collect())
    assert [r.s for r in quality.scored(docs, quality.train(docs, labels), "s").collect()] == [0.5, 0.5]
    assert toxicity.scored(docs, toxicity.train(docs, labels)).columns == docs.columns  # a score column of old is replaced
    assert quality.scored(documents(spark, []), quality.Model()).count() == 0


def test_additive_model_finds_shapes_and_pairs():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.3) & (x[:, 0] < 0.6) | ((x[:, 1] > 0.5) != (x[:, 2] > 0.5)) & (x[:, 3] > 0.1)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    right = ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean()
    assert right > 0.93 and (1, 2) in model.pairs
    plain = quality.Model(model.intercept, model.cuts, model.tables)
    assert right > ((plain.scores(x[3000:]) > 0.5) == y[3000:]).mean() + 0.05


def test_features_of_odd_texts():
    rows = quality.measure([None, "", " \n", "a", "A" * 100_000, "x " * 70, "HELLO!! THERE!!", prose(1, 200), "a\nb\nc"])
    assert np.isfinite(rows).all() and rows.shape == (9, len(quality.NAMES)) and (rows[:3] == 0).all()
    named = dict(zip(quality.NAMES, rows[5]))
    assert named["repeated_words"] == pytest.approx(69 / 70) and named["worst_distinct"] == pytest.approx(1 / 32)


def test_blocks_of_first_columns_fill_evenly(spark):
    # The first columns are the smallest hashes of their sets: ranges of hashes would leave most blocks empty.
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(60))) for i in range(200)], "doc_id long, text string")
    first = ngram_join.sets(docs, whole=False)
    sizes = [r.n for r in ngram_join.in_blocks(first, 6, 6).groupBy("block").agg(F.sum(F.length("columns") / 6).alias("n")).collect()]
    assert len(sizes) == 6 and sum(sizes) > 3000 and max(sizes) < 1.3 * sum(sizes) / 6
