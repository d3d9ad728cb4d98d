"""N-gram Jaccard join: documents whose sets of five-word shingles are alike, and the groups they form.

Documents by shingles is a sparse 0/1 matrix, and the overlaps of all pairs are its product with its own
transpose. That product is not computed and no overlap is accumulated over columns: candidates by prefix bounds that
follow from the set sizes take its place. Blocks of columns (by shingle hash, mixed) only count in how many sets a column occurs:

1. A pair above the threshold shares at least k + 1 of each side's first q + k shingles by hash, where
   q = n - ceil(t n) + 1. Only these columns are counted first; a document with k or fewer columns that occur elsewhere reaches no partner and is done.
2. What is left is counted over whole sets. In order of frequency, rare first, a pair shares one of the
   first q columns: frequent passages fall behind that bound, and a document left with none is done. So is
   one whose shared columns, all together, are too few for the smallest set it meets in a column.
3. Columns propose pairs. Instead of all pairs of a column, each document is first held against one: the most
   typical one (columns in most sets, on average) of the columns that agree most often. Pairs above the threshold link their
   groups, and columns inside one group propose nothing any more. A document x that is not linked with its hub h
   shares o columns with it; a partner y for which o + d are needed must share d of x's columns
   outside h, so x meets those y of other groups in its rarest such columns only, all but d - 1, and each y that shares one of them is proposed. Smaller partners, and groups that meet in a column, are proposed in full across groups. No link between groups is lost.
4. A proposed pair is decided by the overlap of the whole sets: a link if 100 * intersection >= 75 * union.

Equal sets are one class, held once; copies are never expanded into pairs. Hot columns are combined
before every exchange. A null or empty text has no shingles and no links. Rows of a null id are counted but
linked with nothing; their group is null. Columns besides doc_id and text are passed over.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from pluvio.llm.common import stored
from pluvio.llm.components import components
from pluvio.llm.words import mix, shingle_sets
from pluvio.operators.joins import small_side

# Similarity of a link, in hundredths.
THRESHOLD = 75
# Rows of a batch, which sends each of its columns to a block once, and columns a block should hold.
BATCH_ROWS = 4096
BLOCK_COLUMNS = 1 << 20


def least_overlap(n, threshold: int = THRESHOLD):
    """The smallest overlap with which a set of n can belong to a link."""
    return -(-n * threshold // 100)


def needed(a, b, threshold: int = THRESHOLD):
    """The overlap that sets of these sizes need; for numbers and for SQL texts alike in ``_needed``."""
    return -(-threshold * (a + b) // (100 + threshold))


def _needed(a: str, b: str, threshold: int) -> str:
    return f"(({threshold} * ({a} + {b}) + {99 + threshold}) div {100 + threshold})"


def first_columns(n, threshold: int = THRESHOLD):
    """q: so many columns of a set of n hold at least one of any partner's overlap."""
    return n - least_overlap(n, threshold) + 1


def spare_columns(n, threshold: int = THRESHOLD):
    """k: columns taken beside the first q, so that k + 1 must be shared."""
    return first_columns(n, threshold) // 3


def pack(values: np.ndarray, width: int) -> bytes:
    """Unsigned integers below 256 ** width, little-endian."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _class(values: np.ndarray) -> str:
    """128 bits that stand for a set."""
    return "" if not len(values) else f"{int(mix(values).sum(dtype=np.uint64)):016x}{int(mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)):016x}"


def sets(docs: DataFrame, whole: bool, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, batch, class, n and packed columns of every document: the whole set (8 bytes each) or the first q + k (their upper 6)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number = TaskContext.get().partitionId() << 24, 0
        for frame in batches:
            for at in range(0, len(frame), BATCH_ROWS):
                part, out = frame.iloc[at : at + BATCH_ROWS], []
                for values in shingle_sets(part["text"].tolist()):
                    n = len(values)
                    kept = values if whole else values[: first_columns(n, threshold) + spare_columns(n, threshold)] >> np.uint64(16)
                    out.append((_class(values), n, pack(kept, 8 if whole else 6) if n else b""))
                result = pd.DataFrame(out, columns=["cls", "n", "columns"])
                result["doc_id"], result["batch"] = part["doc_id"].tolist(), task + number
                number += 1
                yield result[["doc_id", "batch", "cls", "n", "columns"]]

    schema = "doc_id string, batch long, cls string, n long, columns binary"
    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(rows, schema)
    return read.withColumn("doc_id", F.col("doc_id").cast("long"))


def in_blocks(table: DataFrame, width: int, blocks: int) -> DataFrame:
    """(block, batch, columns, more, counts): the columns of each batch, once each, ascending; those at ``more`` stand in several of its sets.

    A column's block follows from its mixed hash. Its hash itself would not do: the first columns are the smallest of their sets, so ranges of hashes fill unevenly.
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for batch, part in frame.groupby("batch", sort=False):
                values, counts = np.unique(unpack(b"".join(part["columns"]), width), return_counts=True)
                of = ((mix(values) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(of, kind="stable")
                values, counts = values[order], counts[order]
                cuts = np.searchsorted(of[order], np.arange(blocks + 1))
                out = []
                for block in range(blocks):
                    v, c = values[cuts[block] : cuts[block + 1]], counts[cuts[block] : cuts[block + 1]]
                    if len(v):
                        more = np.flatnonzero(c > 1)
                        out.append((block, batch, pack(v, width), more.astype("<u4").tobytes(), c[more].astype("<u4").tobytes()))
                yield pd.DataFrame(out, columns=["block", "batch", "columns", "more", "counts"])

    return table.select("batch", "columns").filter("length(columns) > 0").mapInPandas(
        send, "block int, batch long, columns binary, more binary, counts binary"
    )


def frequencies(table: DataFrame, width: int, total: int) -> DataFrame:
    """Per batch, its columns that occur in two sets or more of ``table``, and in how many.

    A batch sends each of its columns to the column's block once, with its count there.
    """
    blocks = max(1, math.ceil(total / BLOCK_COLUMNS))

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(c, width) for c in frame["columns"]]
        counts = []
        for values, more, many in zip(parts, frame["more"], frame["counts"]):
            c = np.ones(len(values), np.int64)
            c[np.frombuffer(more, "<u4")] = np.frombuffer(many, "<u4")
            counts.append(c)
        values, at = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts)).astype(np.int64)[at]
        out, start = [], 0
        for batch, own in zip(frame["batch"], parts):
            mine = total[start : start + len(own)]
            start += len(own)
            if (mine > 1).any():
                out.append((batch, pack(own[mine > 1], width), mine[mine > 1].astype("<u8").tobytes()))
        return pd.DataFrame(out, columns=["batch", "columns", "counts"])

    return in_blocks(table, width, blocks).groupBy("block").applyInPandas(count, "batch long, columns binary, counts binary")


def _with_frequencies(table: DataFrame, width: int, total: int, decide: Callable, schema: str) -> DataFrame:
    """``decide(row, values, counts)`` for every row with columns, where counts are 1 for columns of that set alone; null results fall away."""

    def rows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        known = np.concatenate([unpack(c, width) for c in right["columns"]] or [np.empty(0, np.uint64)])
        count = np.concatenate([np.frombuffer(c, "<u8") for c in right["counts"]] or [np.empty(0, np.uint64)]).astype(np.int64)
        order = np.argsort(known, kind="stable")
        # A batch may have sent a column in two pieces; both have the same count.
        known, count = np.append(known[order], np.uint64(2**64 - 1)), np.append(count[order], 1)
        out = []
        for row in left.itertuples(index=False):
            values = unpack(row.columns, width)
            at = np.searchsorted(known, values)
            out.append(decide(row, values, np.where(known[at] == values, count[at], 1)))
        names = [c.split()[0] for c in schema.split(", ")]
        return pd.DataFrame([o for o in out if o is not None], columns=names)

    filled = table.filter("n > 0")
    return filled.groupBy("batch").cogroup(frequencies(table, width, total).groupBy("batch")).applyInPandas(rows, schema)


def reachable(table: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Classes, with one document each, that share enough of their first columns with others (step 1)."""

    def decide(row, values, counts):
        smallest = spare_columns(least_overlap(row.n, threshold), threshold)
        return (row.doc_id, row.cls, row.n) if (counts > 1).sum() > smallest else None

    table = table.filter("doc_id is not null")
    total = table.agg(F.sum(F.length("columns") / 6)).first()[0] or 0
    found = _with_frequencies(table, 6, total, decide, "doc_id long, cls string, n long")
    return found.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))


def postings(table: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(column, cls, n, shared, typical) for the first columns, rare first, that other sets have too (step 2).

    ``shared`` is how many columns of the set occur elsewhere: no overlap is larger. ``typical`` is in how many sets its columns
    occur on average (in thousandths): what copies changed is rarer than what they kept.
    """

    def decide(row, values, counts):
        rare = np.lexsort((values, counts))[: first_columns(row.n, threshold)]
        kept, shared = values[rare[counts[rare] > 1]].view(np.int64), int((counts > 1).sum())
        typical = int(counts.sum()) * 1000 // row.n
        return (row.cls, row.n, shared, typical, kept.tolist()) if len(kept) and shared >= least_overlap(row.n, threshold) else None

    total = table.agg(F.sum("n")).first()[0] or 0
    found = _with_frequencies(table, 8, total, decide, "cls string, n long, shared long, typical long, first array<long>")
    posts = stored(found.select(F.explode("first").alias("column"), "cls", "n", "shared", "typical"), "postings")
    smallest = posts.groupBy("column").agg(F.min("n").alias("smallest"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    smallest = smallest.select(F.col("column").alias("_column"), "smallest")
    least = f"greatest(smallest, {_ceil_share('n', threshold)})"
    kept = posts.join(smallest, posts["column"] == smallest["_column"]).filter(f"shared >= {_needed('n', least, threshold)}")
    return kept.select("column", "cls", "n", "shared", "typical")


def _ceil_share(n: str, threshold: int) -> str:
    return f"(({threshold} * {n} + 99) div 100)"


def overlaps(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, both, outside) of ``pairs``: the overlap of the whole sets, and the columns of a that b lacks (step 4)."""
    side = lambda s: whole.select(F.col("cls").alias(s), F.col("n").alias(f"n_{s}"), F.col("columns").alias(f"of_{s}"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            both, outside = [], []
            for a, b in zip(frame["of_a"], frame["of_b"]):
                x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                inside = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
                both.append(int(inside.sum()))
                outside.append(x[~inside].view(np.int64).tolist())
            yield frame[["a", "b", "n_a", "n_b"]].assign(both=both, outside=outside)

    schema = "a string, b string, n_a long, n_b long, both long, outside array<long>"
    return pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").mapInPandas(rows, schema)


def linked_pairs(met: DataFrame, threshold: int) -> DataFrame:
    return met.filter(f"100 * both >= {threshold} * (n_a + n_b - both)").select("a", "b")


def hub_pairs(posts: DataFrame, threshold: int) -> DataFrame:
    """(a, b): each document and the most typical document of the columns that agree most often."""
    pick = F.max(F.struct("typical", F.col("cls").alias("hub"), F.col("n").alias("hub_n")))
    of_column = posts.groupBy(F.col("column").alias("_column")).agg(pick.alias("pick")).select("_column", "pick.hub", "pick.hub_n")
    met = posts.join(of_column, posts["column"] == of_column["_column"])
    met = met.filter((F.col("cls") != F.col("hub")) & close_sizes(F.col("n"), F.col("hub_n"), threshold))
    votes = met.groupBy("cls", "hub").agg(F.count(F.lit(1)).alias("votes"))
    return votes.groupBy(F.col("cls").alias("a")).agg(F.max_by("hub", F.struct("votes", "hub")).alias("b"))


def columns_of(whole: DataFrame) -> DataFrame:
    """(cls, n, column) of whole sets."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield frame[["cls", "n"]].assign(columns=[np.frombuffer(c, "<i8").tolist() for c in frame["columns"]])

    unpacked = whole.select("cls", "n", "columns").mapInPandas(rows, "cls string, n long, columns array<long>")
    return unpacked.select("cls", "n", F.explode("columns").alias("column"))


def outside_holders(unlinked: DataFrame, whole: DataFrame) -> DataFrame:
    """(column, cls, n): the documents that have the columns that unlinked ones have outside their hub."""
    meant = small_side(unlinked.select(F.explode("outside").alias("column")).distinct())
    return columns_of(whole).join(meant, "column", "left_semi").distinct()


def _labelled(rows: DataFrame, cls: str, labels: DataFrame, name: str) -> DataFrame:
    of = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    return rows.join(of, F.col(cls) == F.col("_node"), "left").withColumn(name, F.coalesce("_label", cls)).drop("_node", "_label")


def outside_pairs(unlinked: DataFrame, holders: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """(a, b): documents not linked with their hub, and those of other groups that share enough of their columns outside the hub."""
    # ``small``: a partner of more columns needs more than the overlap with the hub; ``more``: at least so many from outside.
    x = unlinked.withColumn("more", F.expr(f"{_needed('n_a', f'greatest(small + 1, {_ceil_share('n_a', threshold)})', threshold)} - both"))
    sought = x.select("a", "n_a", "both", "small", "more", F.explode("outside").alias("column"))
    often = holders.groupBy("column").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    # Of e outside columns that others have, a partner shares one of the e - more + 1 rarest.
    ranked = sought.join(often, "column").withColumns({
        "place": F.row_number().over(W.partitionBy("a").orderBy("often", "column")),
        "e": F.count(F.lit(1)).over(W.partitionBy("a")),
    })
    rare = ranked.filter("place <= e - more + 1").select(F.col("column").alias("_column"), "a", "n_a", "small", "both", "place", "e")
    # A column that one group holds alone proposes nothing.
    found = stored(_labelled(holders, "cls", labels, "label"), "labelled-holders")
    mixed = found.groupBy("column").agg(F.min("label").alias("one"), F.max("label").alias("other")).filter("one <> other")
    rare = _labelled(rare.join(mixed.select(F.col("column").alias("_column")), "_column", "left_semi"), "a", labels, "label_a")
    # The larger the partner, the more it must share, and the fewer columns are rare enough to be the first.
    first_of = F.col("place") <= F.col("e") - F.expr(_needed("n_a", "n", threshold)) + F.col("both") + 1
    met = found.join(rare, (F.col("column") == F.col("_column")) & (F.col("label") != F.col("label_a"))
                     & (F.col("n") > F.col("small")) & close_sizes(F.col("n"), F.col("n_a"), threshold) & first_of)
    return met.select("a", F.col("cls").alias("b")).distinct()


def across_pairs(posts: DataFrame, unlinked: DataFrame, labels: DataFrame, threshold: int) -> DataFrame:
    """(a, b): in each column the documents outside its largest group, and those of its other groups.

    A document not linked with its hub meets only the partners that ``outside_pairs`` leaves out, those of at most ``small`` columns.
    """
    bound = unlinked.select(F.col("a").alias("_a"), "small")
    live = posts.join(labels, posts["cls"] == labels["node"], "left").select("column", "cls", "n", "shared", F.coalesce("label", "cls").alias("label"))
    of_label = live.groupBy("column", "label").agg(F.count(F.lit(1)).alias("rows"))
    largest = of_label.groupBy(F.col("column").alias("_column")).agg(
        F.max_by("label", F.struct("rows", "label")).alias("largest"), F.count(F.lit(1)).alias("groups")
    )
    largest = largest.filter("groups > 1").drop("groups")
    mixed = stored(live.join(largest, live["column"] == largest["_column"]).drop("_column"), "mixed-columns")
    rest = mixed.filter("label <> largest").join(bound, F.col("cls") == F.col("_a"), "left").select(
        F.col("column").alias("_column"), F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("_shared"),
        F.col("label").alias("_label"), "small",
    )
    rest = rest.filter(f"small is null or small >= {_ceil_share('n_a', threshold)}")
    across = (
        (F.col("column") == F.col("_column")) & (F.col("label") != F.col("_label"))
        & ((F.col("label") == F.col("largest")) | F.col("small").isNotNull() | (F.col("cls") > F.col("a")))
        & (F.col("n") <= F.coalesce("small", "n")) & close_sizes(F.col("n"), F.col("n_a"), threshold)
        & (F.least("shared", "_shared") >= F.expr(_needed("n", "n_a", threshold)))
    )
    return mixed.join(rest, across).select("a", F.col("cls").alias("b")).distinct()


def close_sizes(a, b, threshold: int = THRESHOLD):
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold


def linked(posts: DataFrame, whole: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(node, label) of the groups that the classes of ``posts`` form (step 3)."""
    met = stored(overlaps(hub_pairs(posts, threshold), whole), "hub-pairs")
    links = linked_pairs(met, threshold)
    labels = components(links)
    unlinked = met.join(links, ["a", "b"], "left_anti").withColumn(
        "small", F.expr(f"({100 + threshold} * both) div {threshold} - n_a")
    )
    unlinked = stored(unlinked, "unlinked")
    # A document without a column left in step 2 is no one's partner.
    partners = whole.join(small_side(posts.select("cls").distinct()), "cls", "left_semi")
    holders = stored(outside_holders(unlinked, partners), "outside-columns")
    pairs = outside_pairs(unlinked, holders, labels, threshold).union(across_pairs(posts, unlinked, labels, threshold))
    pairs = stored(pairs.distinct(), "pairs")
    if pairs.isEmpty():
        return labels
    more = linked_pairs(overlaps(pairs, whole), threshold)
    return components(links.union(more))


def ngram_groups(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, of every row."""
    first = stored(sets(docs, whole=False, threshold=threshold), "first-columns")
    some = stored(reachable(first, threshold), "reachable")
    ids = small_side(some.select("doc_id").distinct())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    if not first.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        texts = texts.dropDuplicates(["doc_id", "text"])
    whole = sets(texts, whole=True, threshold=threshold).join(small_side(some.select("cls")), "cls", "left_semi")
    whole = stored(whole, "whole-sets")
    posts = stored(postings(whole, threshold), "first-postings")
    labels = linked(posts, whole, threshold)
    # Ids by class first, then by group: a class or group of many rows is combined before the exchange.
    rows = first.select("doc_id", "n", "cls")
    ids = rows.filter("n > 0 and doc_id is not null").groupBy("cls").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    ids = ids.join(labels, ids["cls"] == labels["node"], "left").withColumn("label", F.coalesce("label", "cls"))
    several = stored(ids.filter("node is not null or rows > 1").select("cls", "label", "least"), "classes")
    of_group = several.groupBy("label").agg(F.min("least").alias("component"))
    of_class = stored(several.join(of_group, "label").select(F.col("cls").alias("_cls"), "component"), "groups")
    joined = rows.join(of_class, rows["cls"] == of_class["_cls"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
