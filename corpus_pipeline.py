"""The corpus pipeline: stages over the documents table, each written as Parquet and read back as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pluvio.llm import line_dedup, mixing, ngram_join, packing, toxicity
from pluvio.llm.common import on_workers, set_apart, stored, table
from pluvio.llm.registry import tokenizer_path
from pluvio.operators.joins import small_side


@on_workers
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the cut, whatever their other columns. The classifier learns from the labels outside the held-out fold.

    A null or empty text scores as the intercept and stays; rows of a repeated id are scored each; without documents there are no rows.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.learning_rows())
    shielded, own = set_apart(docs, "_toxic")
    return toxicity.scored(shielded, model, "_toxic").filter(F.col("_toxic") < toxicity.CUT).select(own)


@on_workers
def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; none is dropped. A null text stays null, a null source is one of its own."""
    kept = line_dedup.drop_lines(docs, site="source", ratio=0.05, min_pages=5, counts=False)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


@on_workers
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of smallest id. Rows alike in id and text are one; rows of a null id stay."""
    groups = stored(ngram_join.ngram_groups(docs, threshold=75), "near-copies").filter("doc_id is not null")
    ids = stored(groups.groupBy("doc_id").agg(F.max(F.expr("component_id = doc_id")).alias("stays"), F.count(F.lit(1)).alias("rows")).filter("not stays or rows > 1"), "ids")
    gone, several = (small_side(ids.filter(c).select("doc_id")) for c in ("not stays", "stays"))
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    if ids.filter("stays").isEmpty():
        return kept
    once = kept.join(several, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return kept.join(several, "doc_id", "left_anti").select(docs.columns).union(once)


@on_workers
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by capped weights; a document taken twice comes twice. A text without words counts 0 and comes as often as its source does in whole."""
    return mixing.mix(docs, cycle=(3, 1, 2), budget=1.5, max_epochs=2.0)


@on_workers
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixture in sequences of at most 2,048 tokens; a null or empty text is one end token."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A trained classifier and a tokenizer are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


@on_workers
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
