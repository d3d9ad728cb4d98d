"""The corpus pipeline, stage by stage, against brute force on what the stage before it kept."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from pluvio.llm import toxicity
from pluvio.llm.common import stored

from .helpers import WORD, documents, groups, prose
from .test_text import check_packing, stripped

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark):
    """Input and output rows of every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        out.append((name, docs))
    return {name: (df.columns, df.collect()) for name, df in out}


def rows_of(kept, name):
    return [(r.doc_id, r.text, r.source) for r in kept[name][1]]


def test_stages_return_documents(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "mixing", "packing"]
    for name in ("toxicity", "line_dedup", "ngram_join", "mixing"):
        assert kept[name][0] == COLUMNS
    assert all(r.n_chars == len(r.text) for r in kept["line_dedup"][1])


def test_toxic_documents_go_and_clean_ones_stay(spark, kept):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(docs, labels, toxicity.learning_rows())
    want = sorted(r[0] for r in rows_of(kept, "documents") if model.scores([r[1]])[0] < toxicity.CUT)
    assert sorted(r[0] for r in rows_of(kept, "toxicity")) == want
    clean = {r.doc_id for r in labels.filter("toxic = 0").collect()}
    assert len(clean & set(want)) >= 0.95 * len(clean)


def test_line_dedup_stage(kept):
    got = sorted((str(i), t, s or "") for i, t, s in rows_of(kept, "line_dedup"))
    assert got == stripped(rows_of(kept, "toxicity"), 0.05, 5)


def test_one_document_of_each_group_stays(kept):
    before = rows_of(kept, "line_dedup")
    want = {i for i, _, least in groups([(i, t) for i, t, _ in before]) if i == least}
    assert sorted(r[0] for r in rows_of(kept, "ngram_join")) == sorted(want)


def test_mixture(kept):
    before, after = rows_of(kept, "ngram_join"), rows_of(kept, "mixing")
    size = {i: len(WORD.findall(t or "")) for i, t, _ in before}
    source = {i: s for i, _, s in before}
    taken = Counter(r[0] for r in after)
    assert max(taken.values()) <= 2 and set(after) <= set(before)
    totals, words = defaultdict(int), defaultdict(int)
    for i in size:
        totals[source[i]] += size[i]
        words[source[i]] += size[i] * taken[i]
    names = sorted(totals)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(totals.values())
    while True:  # clamp and reshare, round by round
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= 2 * totals[s]}
        if not over:
            break
        for s in over:
            target[s] = 2 * totals[s]
            left -= target[s]
        free -= over
    target |= {s: level * weight[s] for s in free}
    assert all(abs(words[s] - target[s]) <= max(size.values()) / 2 for s in names)


def test_packing_stage(spark, kept):
    after = kept["packing"][1]
    copies = Counter(r[0] for r in rows_of(kept, "mixing"))
    assert Counter(r.doc_id for r in after if r.start == 0) == copies
    assert sum(r.length for r in after) == sum(r.doc_tokens for r in after if r.start == 0)
    once = [r for r in after if copies[r.doc_id] == 1]
    check_docs = {r[0]: r[1] for r in rows_of(kept, "mixing") if copies[r[0]] == 1}
    by_sequence = defaultdict(int)
    for r in after:
        by_sequence[r.sequence_id] += r.length
    assert max(by_sequence.values()) <= 2048 and set(check_docs) == {r.doc_id for r in once}


def test_run_gives_the_last_stage(spark, kept):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, got.drop("step_group", "sequence_id", "offset").collect())) == sorted(
        str(r) for r in got.sparkSession.createDataFrame(kept["packing"][1], got.schema).drop("step_group", "sequence_id", "offset").collect())


def test_stages_on_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "x y z", "a"), (3, "x y z", "a"), (4, prose(1, 50), "b"), (5, prose(1, 50), "b"), (None, "no id at all", "c")]
    for given in (rows, []):
        docs = documents(spark, given)
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), name)
            if name == "ngram_join":
                assert Counter(r.doc_id for r in docs.collect()) == (Counter([1, 2, 3, 4, None]) if given else Counter())
        assert (docs.count() > 0) == bool(given)


def test_columns_named_like_the_stages_own_stay(spark):
    names = ["_toxic", "_site", "_keys", "_kept", "_lines", "_dropped", "_source", "_source_size", "_target", "_whole", "_cutoff", "_repeats", "_copy"]
    docs = documents(spark, [(i, f"line {i}\ncommon line\n{prose(i, 30)}", "s") for i in range(12)], extra=False)
    docs = docs.selectExpr("*", *[f"'{n}' as {n}" for n in names])
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert {tuple(r[n] for n in names) for r in out.select(names).collect()} == {tuple(names)}, name
