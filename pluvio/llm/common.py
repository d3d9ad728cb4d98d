"""What several operators share: stored intermediates, column expressions and ranks without a global sort."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from pluvio.operators.joins import small_side
from pluvio.session import work_dir

# A word of a text, in Java's, RE2's and Python's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"


# Python workers are used again by later stages; with these they give large arrays back instead of keeping them.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(8 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20),
                 "MALLOC_ARENA_MAX": "2"}
# Rows that go to a Python worker at a time; documents are long.
BATCH_ROWS = 1024


def on_workers(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``query(spark, ...)`` whose Python workers look for this package where the driver found it, besides their own path, and
    have the settings of ``WORKER_MEMORY`` where the session sets no others. Batches are limited for the session."""

    @wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
        path = environment.get("PYTHONPATH", "").split(":")
        if root not in path:
            environment["PYTHONPATH"] = ":".join([root, *filter(None, path)])
        for name, value in WORKER_MEMORY.items():
            environment.setdefault(name, value)
        if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return query(spark, *rest)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder all executors share and read back: the lineage ends here, and a lost executor costs nothing."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_runs(texts: Sequence[bytes | None], limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """The texts (empty for null) in runs of at most ``limit`` bytes, or of one text."""
    run, size = [], 0
    for text in texts:
        data = text or b""
        if run and size + len(data) > limit:
            yield run
            run, size = [], 0
        run.append(data)
        size += len(data)
    if run:
        yield run


def set_apart(docs: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with columns of these names called otherwise, and the columns that bring all of its own back under their names."""
    other = {c: f"{c}__{i}" for i, c in enumerate(docs.columns) if c.lower() in names}
    return docs.withColumnsRenamed(other), [F.col(f"`{other.get(c, c)}`").alias(c) for c in docs.columns]


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_key(ident: Column, seed: str) -> Column:
    """A place in a shuffled order that depends on the id and the seed alone: 32 hex digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))))


def ranked(df: DataFrame, group: list[str], bucket: str, order: list[Column], rank: str) -> DataFrame:
    """Gapless ranks from 0 within ``group``, without bringing a group together.

    ``bucket`` is a column that grows with ``order`` and cuts every group into pieces. Pieces are counted
    first; a row's rank is the count of the pieces before its own plus its place there.
    """
    sizes = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(f"_{c}") for c in [*group, bucket]], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    placed = df.withColumn("_place", F.row_number().over(W.partitionBy(*group, bucket).orderBy(*order)) - 1)
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*group, bucket]]
    joined = placed.join(small_side(starts), on, "left").withColumn(rank, (F.col("_start") + F.col("_place")).cast("long"))
    return joined.drop("_place", "_start", *[f"_{c}" for c in [*group, bucket]])
