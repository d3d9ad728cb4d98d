"""Approximate nearest neighbours by a robust-pruned directed graph in every shard.

Rows are dealt to shards by a hash of their id. In a shard, equal vectors are one node; nodes are inserted in a
seeded order, many at once: a greedy beam search through the graph so far proposes neighbours, and
relaxed pruning keeps an edge to the nearest proposal and drops those that are ``alpha`` times nearer to a kept one than to the
node. Edges are also laid back and pruned again, and a second pass goes over the full graph. A query is searched in
every shard by the same beam search, in double precision, on points that are centred and scaled by shard; what the
beams find is measured again on the vectors as given, and the nearest of all shards are kept. A query whose beam comes
back short or that lies far from a shard, and a shard whose points differ too much in magnitude to be squared, is
answered by a scan of that shard.

The graph table indexes every row. Vectors that are null, empty, zero, or hold a null or non-finite component take no
part; vectors of another length than a query's are no candidates for it (shards are split by length).
Rows of a null id take no part. Of equal vectors only the k + 1 smallest ids of a shard can be among a query's k nearest, so that many are
enough as candidates. Ties go to the smaller id; repeated ids are candidates each, except the query's own id, and one query.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from pluvio.llm.common import stored

SHARD_ROWS = 4096
DEGREE, BEAM, ALPHA = 32, 96, 1.2
SEED = 11
# Nodes inserted, or queries searched, in one go; queries that meet a shard in one task.
TOGETHER = 256
BLOCK_QUERIES = 16_384
# A query this many times farther from a shard's centre than its median vector is held against all of the shard, and
# vectors that far against every query: no edges lead there.
FAR, TINY = 64.0, 1e-300


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles, dims) of the vectors that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    kept = kept.filter(finite & F.exists(v, lambda x: x != 0))
    return kept.select("vec_id", v.cast("array<double>").alias("embedding"), F.size(v).alias("dims"))


def placing(exact: np.ndarray) -> tuple[float, np.ndarray, bool]:
    """A power of two and a centre that bring a shard's vectors near the unit cube, and whether squared distances there tell them apart.

    The centre is the median, which a few vectors far away do not move.
    """
    scale = 2.0 ** max(-1022, min(1023, int(np.frexp(np.abs(exact).max())[1])))
    centre = np.median(exact / scale, axis=0)
    away = np.abs(exact / scale - centre).max(1)
    return scale, centre, bool((away[away > 0] > 1e-120).all())


def placed(vectors: np.ndarray, scale: float, centre: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return vectors / scale - centre


def exact_distances(points: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, scaled where squares leave its range."""
    with np.errstate(over="ignore", invalid="ignore"):
        score = np.sqrt(((points - vector) ** 2).sum(1))
        for i in np.flatnonzero(~((score > 1e-140) & (score < np.inf))):
            half = points[i] / 2 - vector / 2 if not np.isfinite(score[i]) else points[i] - vector
            most = np.abs(half).max()
            if most > 0:
                score[i] = most * np.sqrt(((half / most) ** 2).sum()) * (1 if np.isfinite(score[i]) else 2)
    return score


def _distances(points: np.ndarray, norms: np.ndarray, at: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances from each query to its own candidates."""
    return norms[at] - 2 * np.matmul(points[at], queries[:, :, None])[:, :, 0] + (queries * queries).sum(1)[:, None]


def beam_search(points: np.ndarray, norms: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the nodes of its beam, nearest first, and their squared distances; -1 and infinity fill short beams.

    ``edges`` has a row of neighbours for each node, -1 where there are fewer.
    """
    n, q = len(points), len(queries)
    ids = np.full((q, beam), -1, np.int64)
    near = np.full((q, beam), np.inf, points.dtype)
    done = np.ones((q, beam), bool)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True
    ids[:, 0], done[:, 0], seen[:, start] = start, False, True
    near[:, 0] = _distances(points, norms, np.full((q, 1), start), queries)[:, 0]
    live = np.arange(q)
    while len(live):
        open_at = np.argmin(done[live], axis=1)
        done[live, open_at] = True
        found = edges[ids[live, open_at]]
        found = np.where(found < 0, n, found)
        fresh = ~seen[live[:, None], found]
        seen[live[:, None], found] = True
        # Within one row of edges no node comes twice.
        distance = np.where(fresh, _distances(points, norms, np.minimum(found, n - 1), queries[live]), np.inf)
        all_ids = np.concatenate([ids[live], found], 1)
        all_near = np.concatenate([near[live], distance], 1)
        all_done = np.concatenate([done[live], ~fresh], 1)
        order = np.argsort(all_near, axis=1, kind="stable")[:, :beam]
        row = np.arange(len(live))[:, None]
        ids[live], near[live] = all_ids[row, order], all_near[row, order]
        done[live] = all_done[row, order] | ~np.isfinite(near[live])
        live = live[~done[live].all(1)]
    return np.where(np.isfinite(near), ids, -1), near


def robust_prune(points: np.ndarray, node: int, proposed: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Of the proposed neighbours, ascending by distance, those that no kept one covers."""
    proposed = np.unique(proposed[(proposed >= 0) & (proposed != node)])
    rows = points[proposed]
    gap = ((rows - points[node]) ** 2).sum(1)
    order = np.argsort(gap, kind="stable")
    proposed, rows, gap = proposed[order], rows[order], gap[order]
    between = (rows * rows).sum(1)[:, None] - 2 * rows @ rows.T + (rows * rows).sum(1)[None, :]
    alive, kept = np.ones(len(proposed), bool), []
    while len(kept) < degree and alive.any():
        first = int(np.argmax(alive))
        kept.append(first)
        # Squared distances, so alpha is squared too.
        alive &= alpha * alpha * between[first] > gap
        alive[first] = False
    return proposed[kept]


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = SEED) -> tuple[np.ndarray, int]:
    """Edges of every node and the node to start from (the one nearest to the mean)."""
    n = len(points)
    norms = (points * points).sum(1)
    start = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
    edges = np.full((n, degree), -1, np.int64)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    for turn, strictness in enumerate((1.0, alpha)):
        at = 1 if turn == 0 else 0
        while at < n:
            # The first nodes go in few at a time, so that later ones find a graph.
            group = order[at : at + (TOGETHER if turn else min(TOGETHER, max(1, at)))]
            at += len(group)
            reached, _ = beam_search(points, norms, edges, start, points[group], beam if turn else beam // 2)
            back: dict[int, list[int]] = {}
            for node, proposed in zip(group.tolist(), reached):
                extra = edges[node] if turn else group
                kept = robust_prune(points, node, np.concatenate([proposed, extra]), strictness, degree)
                edges[node] = -1
                edges[node, : len(kept)] = kept
                for other in kept.tolist():
                    back.setdefault(other, []).append(node)
            for other, nodes in back.items():
                own = edges[other][edges[other] >= 0]
                union = np.union1d(own, nodes)
                if len(union) > degree:
                    union = robust_prune(points, other, union, strictness, degree)
                edges[other] = -1
                edges[other, : len(union)] = union
    return edges, start


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> DataFrame:
    """The graph table: shard, dims, node, vec_ids of the node (ascending), embedding, neighbours, and whether to start there."""
    rows = usable(vectors)
    shards = max(1, math.ceil(vectors.count() / shard_rows))

    def graph(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        exact = np.array(frame["embedding"].tolist(), np.float64)
        distinct, node = np.unique(exact, axis=0, return_inverse=True)
        scale, centre, _ = placing(distinct)
        edges, start = build(placed(distinct, scale, centre), degree, beam, alpha)
        order = np.argsort(node.ravel(), kind="stable")
        members = np.split(frame["vec_id"].to_numpy()[order], np.cumsum(np.bincount(node.ravel()))[:-1])
        return pd.DataFrame({
            "shard": frame["shard"].iloc[0], "dims": frame["dims"].iloc[0], "node": np.arange(len(distinct)),
            "vec_ids": [m.tolist() for m in members], "embedding": distinct.tolist(),
            "neighbours": [e[e >= 0].tolist() for e in edges], "start": np.arange(len(distinct)) == start,
        })

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard", "dims").applyInPandas(
        graph, "shard int, dims int, node int, vec_ids array<long>, embedding array<double>, neighbours array<int>, start boolean"
    )


def search(graphs: DataFrame, queries: DataFrame, k: int = 10, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest found for every usable query row."""
    asked = usable(queries).groupBy(F.col("vec_id").alias("query_id"), "dims").agg(F.min("embedding").alias("embedding"))
    blocks = max(1, math.ceil(asked.count() / BLOCK_QUERIES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    # Each shard answers all queries of its length, block by block: the stated query set against all rows.
    shards = graphs.select(F.col("shard").alias("in_shard"), F.col("dims").alias("in_dims")).distinct()
    copies = asked.join(shards, F.col("dims") == F.col("in_dims")).select("query_id", "embedding", "in_shard", "in_dims", "block")
    graphs = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["shard", "dims", "block"]

    def answer(graph: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(graph) and len(asks):
            graph = graph.sort_values("node")
            exact = np.array(graph["embedding"].tolist(), np.float64)
            scale, centre, told = placing(exact)
            points = placed(exact, scale, centre)
            away = np.abs(points).max(1)
            bound = FAR * max(np.median(away), TINY)
            far = np.flatnonzero(away > bound)
            norms = (points * points).sum(1)
            edges = np.full((len(graph), max(1, graph["neighbours"].map(len).max())), -1, np.int64)
            for row, found in zip(edges, graph["neighbours"]):
                row[: len(found)] = found
            start = int(np.argmax(graph["start"].to_numpy()))
            members = [np.asarray(m, np.int64)[: k + 1] for m in graph["vec_ids"]]
            asks = asks.sort_values("query_id")
            for at in range(0, len(asks), TOGETHER):
                ids = asks["query_id"].to_numpy()[at : at + TOGETHER]
                vectors = np.array(asks["embedding"].iloc[at : at + TOGETHER].tolist(), np.float64)
                asked_at = placed(vectors, scale, centre)
                usual = told & (np.abs(asked_at).max(1) <= bound)
                nodes, _ = beam_search(points, norms, edges, start, np.where(usual[:, None], asked_at, 0.0), max(beam, k + 1))
                for query, vector, reached, usable_beam in zip(ids, vectors, nodes, usual):
                    reached = reached[reached >= 0]
                    if not usable_beam or len(reached) < min(len(points), max(beam, k + 1)):
                        reached = np.arange(len(points))
                    elif len(far):
                        reached = np.union1d(reached, far)
                    score = exact_distances(exact[reached], vector)
                    candidates = np.concatenate([members[i] for i in reached])
                    scores = np.repeat(score, [len(members[i]) for i in reached])
                    other = candidates != query
                    candidates, scores = candidates[other], scores[other]
                    best = np.lexsort((candidates, scores))[:k]
                    out.append(pd.DataFrame({"query_id": query, "vec_id": candidates[best], "score": scores[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})

    found = graphs.groupBy(*keys).cogroup(copies.groupBy("in_shard", "in_dims", "block")).applyInPandas(
        answer, "query_id long, vec_id long, score double"
    )
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """The k nearest of every row whose id is divisible by ``every``."""
    graphs = stored(index(vectors), "graphs")
    return search(graphs, vectors.filter(F.col("vec_id") % every == 0), k)

