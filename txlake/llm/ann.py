"""Approximate nearest neighbours on robust-pruned directed graphs, one graph per shard.

Distinct vectors are dealt to shards of a bounded number by hash; each shard is one task, which builds a
graph: points are inserted in batches, a greedy search through the graph so far proposes neighbours,
and relaxed distance pruning keeps those that no closer kept one covers. Queries go to every shard in
blocks; a beam search walks the graph and reports its best points, scored exactly on the original
vectors. The best of all shards are merged by score.

For the largest inner product, a coordinate is added to every point that brings all to the same length;
then the nearest point and the largest product agree. That holds only among points of similar lengths: beside a
far longer one all others lie at one spot. So the points of a shard are parted by length into bands,
each with a graph of its own, and a query searches every band of every shard.

Vectors of another number of components have no product with a query: shards are dealt per number.

Copies of a vector are one point, so a vector that a third of all rows hold is no obstacle in a graph;
each point carries the smallest ids of its copies, no more than a result can show.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.common import column
from txlake.operators.ordering import top_k
from txlake.session import stage

DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
ALPHA = 1.2
SHARD_POINTS = 8192
QUERY_BLOCK = 4096
BATCH = 512
PRUNE_FROM = 96
# The longest point of a band is less than 2 ** BAND_OCTAVES times as long as the shortest.
BAND_OCTAVES = 2
INDEX = "shard int, dim int, point long, node string, vec array<double>, edges array<int>, place int, band int, starts int"


def beam_search(
    queries: np.ndarray, points: np.ndarray, graph: np.ndarray, start: np.ndarray, width: int, less: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-first search for a batch of queries at once.

    Returns (ids, products, visited): for each query its ``width`` best points by inner product, best
    first, -1 where there are fewer, and all points whose edges were followed, -1 where done. ``less``
    is taken from the products with each point; with half the squared lengths the nearest point is best.
    """
    n = len(queries)
    less = np.zeros(len(points), dtype=points.dtype) if less is None else less
    ids = np.full((n, width), -1, dtype=np.int64)
    prods = np.full((n, width), -np.inf, dtype=points.dtype)
    done = np.ones((n, width), dtype=bool)
    first = start[:width]
    ids[:, : len(first)] = first
    prods[:, : len(first)] = queries @ points[first].T - less[first]
    done[:, : len(first)] = False
    order = np.argsort(-prods, axis=1, kind="stable")
    ids, prods, done = (np.take_along_axis(a, order, axis=1) for a in (ids, prods, done))
    visited = []
    rows = np.arange(n)
    while True:
        open_ = ~done
        rows = np.flatnonzero(open_.any(axis=1))
        if not len(rows):
            break
        at = open_[rows].argmax(axis=1)
        here = ids[rows, at]
        done[rows, at] = True
        step = np.full(n, -1, dtype=np.int64)
        step[rows] = here
        visited.append(step)
        near = graph[here]
        known = (near[:, :, None] == ids[rows][:, None, :]).any(axis=2) | (near < 0)
        new = np.einsum("qd,qrd->qr", queries[rows], points[near]) - less[near]
        new[known] = -np.inf
        near = np.where(known, -1, near)
        all_ids = np.concatenate([ids[rows], near], axis=1)
        all_prods = np.concatenate([prods[rows], new], axis=1)
        all_done = np.concatenate([done[rows], known], axis=1)
        order = np.argsort(-all_prods, axis=1, kind="stable")[:, :width]
        ids[rows] = np.take_along_axis(all_ids, order, axis=1)
        prods[rows] = np.take_along_axis(all_prods, order, axis=1)
        done[rows] = np.take_along_axis(all_done, order, axis=1)
    return ids, prods, np.stack(visited, axis=1) if visited else np.empty((n, 0), dtype=np.int64)


def robust_prune(centres: np.ndarray, candidates: np.ndarray, points: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each centre the candidates (ids, -1 for none) that stay, nearest first, -1 where fewer.

    The nearest is kept, and it removes those that are nearer to it than to the centre by the factor
    ``alpha``; so on with the nearest of the rest. Distances are those of the ways from the centre, so
    they are exact to the scale of a centre's candidates, wherever all of them lie.
    """
    cand = np.sort(candidates, axis=1)
    repeated = np.zeros(cand.shape, dtype=bool)
    repeated[:, 1:] = cand[:, 1:] == cand[:, :-1]
    cand = np.where(repeated | (cand == centres[:, None]), -1, cand)
    ways = points[cand] - points[centres][:, None]
    d = np.where(cand < 0, np.inf, np.einsum("bcd,bcd->bc", ways, ways))
    order = np.argsort(d, axis=1, kind="stable")[:, :PRUNE_FROM]
    cand, d = np.take_along_axis(cand, order, axis=1), np.take_along_axis(d, order, axis=1)
    ways = np.take_along_axis(ways, order[:, :, None], axis=1)
    squares = np.einsum("bcd,bcd->bc", ways, ways)
    between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(ways, ways.transpose(0, 2, 1))
    alive = cand >= 0
    out = np.full((len(centres), degree), -1, dtype=np.int64)
    rows = np.arange(len(centres))
    for k in range(degree):
        best = np.where(alive, d, np.inf).argmin(axis=1)
        some = alive[rows, best]
        if not some.any():
            break
        out[some, k] = cand[some, best[some]]
        covered = alpha * alpha * np.maximum(between[rows, best], 0) <= d
        covered[rows, best] = True
        alive &= ~(covered & some[:, None])
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(graph, start): neighbours of each point, -1 where fewer, and the points where searches begin.

    ``points`` are distinct; nearness is their distance.
    """
    n = len(points)
    half = (points * points).sum(axis=1) / 2
    rng = np.random.default_rng(seed)
    graph = np.full((n, degree), -1, dtype=np.int64)
    if n <= degree + 1:
        for i in range(n):
            graph[i, : n - 1] = np.delete(np.arange(n), i)
        return graph, np.arange(min(n, 1))
    graph[:, : degree // 2] = (np.arange(n)[:, None] + rng.integers(1, n, size=(n, degree // 2))) % n
    middle = int(np.argmax(points @ points.mean(axis=0) - half))
    start = np.unique(np.concatenate([[middle], rng.integers(0, n, size=7)]))
    order = rng.permutation(n)
    for lo in range(0, n, BATCH):
        batch = order[lo : lo + BATCH]
        ids, _, visited = beam_search(points[batch], points, graph, start, beam, half)
        kept = robust_prune(batch, np.concatenate([ids, visited, graph[batch]], axis=1), points, degree, alpha)
        graph[batch] = kept
        _add_reverse(graph, points, batch, kept, degree, alpha)
    return graph, start


def _add_reverse(graph: np.ndarray, points: np.ndarray, sources: np.ndarray, kept: np.ndarray, degree: int, alpha: float) -> None:
    """Every kept neighbour gets an edge back; where that is too many, its edges are pruned."""
    targets = kept.ravel()
    back = np.repeat(sources, kept.shape[1])[targets >= 0]
    targets = targets[targets >= 0]
    order = np.argsort(targets, kind="stable")
    targets, back = targets[order], back[order]
    heads, first, count = np.unique(targets, return_index=True, return_counts=True)
    # Points with about as many new edges are handled together, so that few cells are padding.
    for part in np.array_split(np.argsort(count, kind="stable"), max(1, len(heads) // 256)):
        if not len(part):
            continue
        new = np.full((len(part), count[part].max()), -1, dtype=np.int64)
        for row, p in enumerate(part):
            new[row, : count[p]] = back[first[p] : first[p] + count[p]]
        graph[heads[part]] = robust_prune(heads[part], np.concatenate([graph[heads[part]], new], axis=1), points, degree, alpha)


def length_bands(vecs: np.ndarray) -> np.ndarray:
    """The band of each vector, 0 with the longest. Bands count from the longest, so vectors of about
    one length share a band."""
    top = np.abs(vecs).max(axis=1)
    octave = np.log2(top) + np.log2(((vecs / top[:, None]) ** 2).sum(axis=1)) / 2
    return np.floor((octave.max() - octave) / BAND_OCTAVES).astype(np.int64)


def _same_length(vecs: np.ndarray) -> np.ndarray:
    """The vectors, scaled alike, with the coordinate that brings them to the longest length of all.

    The coordinate is given as what it lacks to that length, ``most - rest``, in a form without a
    difference of close numbers: distances are the same, and small ones keep their digits.
    """
    scaled = vecs / np.abs(vecs).max()
    square = (scaled * scaled).sum(axis=1)
    rest = np.sqrt(square.max() - square)
    return np.concatenate([scaled, (square / (np.sqrt(square.max()) + rest))[:, None]], axis=1)


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, h1, h2, vec) of the rows that take part; equal rows once."""
    vec = column(rows, vec_col).cast("array<double>")
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vec", lambda x: x != 0)
    found = rows.select(column(rows, id_col).cast("long").alias("id"), vec.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & ~odd & some
    )
    found = found.select("id", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"), "vec")
    return found.withColumn("node", F.concat_ws(":", "h1", "h2")).drop("h1", "h2")


def nearest(
    rows: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
    shard_points: int = SHARD_POINTS, beam: int = SEARCH_BEAM,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row whose id ``every`` divides.

    Nearness is the largest inner product in double precision; ties go to the smaller id; the query's
    own id is no candidate. Rows with a null id, a null or zero vector, or a null or non-finite
    component take no part. A query is compared with the vectors of its own number of components.
    Rows that repeat id and vector count once; an id with several vectors is a candidate with each of
    them. All rows are in the index. An empty table gives no rows.
    """
    spark = rows.sparkSession
    good = stage(valid_vectors(rows, id_col, vec_col), "vectors")
    ids = good.select("node", "id").distinct()
    # The k + 1 smallest ids of each vector, in two rounds, so that no task sorts a hot one whole.
    few = top_k(ids, ["node"], ["id"], k + 1, "nth", spread="id", at_most=k + 1)
    copies = few.groupBy("node").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = good.groupBy("node").agg(F.min("id").alias("point"), F.first("vec").alias("vec"), F.max((F.col("id") % every == 0).cast("int")).alias("asked"))
    points = stage(points, "points")
    sums = points.agg(F.count(F.lit(1)).alias("n"), F.sum("asked").alias("asked")).first()
    n_shards = -(-sums["n"] // shard_points)
    if not sums["asked"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dealt = points.withColumn("shard", F.pmod(F.xxhash64(F.lit(3), "node"), F.lit(n_shards)).cast("int")).withColumn("dim", F.size("vec"))
    index = stage(dealt.groupBy("shard", "dim").applyInPandas(_index, INDEX), "graphs")

    n_blocks = -(-sums["asked"] // QUERY_BLOCK)
    block = F.pmod(F.xxhash64(F.lit(5), "node"), F.lit(n_blocks)).cast("int")
    asked = points.where("asked = 1").select("node", "vec", F.size("vec").alias("dim"), block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<int>")))
    found = held.groupBy("shard", "dim", "block").cogroup(asked.groupBy("shard", "dim", "block")).applyInPandas(
        _searcher(k + 1, beam), "query string, node string, point long, score double"
    )
    # A query has (k + 1) * shards rows here; the ids of better points come before those of others.
    best = top_k(stage(found, "found"), ["query"], [F.desc("score"), "point", "node"], k + 1, "nth", spread="node", at_most=k + 1)
    listed = best.join(copies, "node").select("query", "score", F.explode("ids").alias("id"))
    listed = listed.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "id"))).alias("near"))
    queries = ids.where(F.col("id") % every == 0).select(F.col("node").alias("query"), F.col("id").alias("query_id"))
    met = queries.join(listed, "query").select("query_id", F.col("query"), F.expr(f"slice(filter(near, x -> x.id != query_id), 1, {int(k)})").alias("near"))
    return met.select("query_id", F.posexplode("near").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.far")).alias("score")
    )


def _index(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values("node", ignore_index=True)
    vecs = np.stack(shard["vec"])
    bands = length_bands(vecs)
    parts, before = [], 0
    for band in np.unique(bands):
        rows = np.flatnonzero(bands == band)
        graph, start = build_graph(_same_length(vecs[rows]))
        # Points where searches begin stand first.
        order = np.concatenate([start, np.setdiff1d(np.arange(len(rows)), start)])
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        out = shard[["shard", "dim", "point", "node", "vec"]].iloc[rows[order]].copy()
        out["edges"] = [place[e[e >= 0]].tolist() for e in graph[order]]
        out["place"], out["band"], out["starts"] = before + np.arange(len(rows)), band, len(start)
        parts.append(out)
        before += len(rows)
    return pd.concat(parts, ignore_index=True)


def _searcher(k: int, beam: int):
    def search(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if index.empty or asked.empty:
            return pd.DataFrame({"query": [], "node": [], "point": [], "score": []}).astype({"query": str, "node": str, "point": "int64", "score": float})
        index = index.sort_values("place", ignore_index=True)
        vecs = np.stack(index["vec"])
        names, ids = index["node"].to_numpy(), index["point"].to_numpy()
        graphs = []
        for _, part in index.groupby("band"):
            graph = np.full((len(part), max(1, max(map(len, part["edges"])))), -1, dtype=np.int64)
            for row, edges in enumerate(part["edges"]):
                graph[row, : len(edges)] = edges
            first = part.index[0]
            graphs.append((first, _same_length(vecs[first : first + len(part)]), graph, np.arange(part["starts"].iloc[0])))
        parts = []
        for lo in range(0, len(asked), BATCH):
            some = asked.iloc[lo : lo + BATCH]
            own = np.stack(some["vec"])
            sought = np.concatenate([own / np.abs(own).max(axis=1, keepdims=True), np.zeros((len(own), 1))], axis=1)
            near = []
            for first, points, graph, start in graphs:
                held, _, _ = beam_search(sought, points, graph, start, min(beam, len(points)))
                near.append(np.where(held < 0, -1, held + first))
            near = np.concatenate(near, axis=1)
            exact = np.einsum("qd,qrd->qr", own, vecs[near])
            exact[near < 0] = -np.inf
            order = np.lexsort((ids[near], -exact), axis=1)[:, :k]
            near, exact = np.take_along_axis(near, order, axis=1), np.take_along_axis(exact, order, axis=1)
            hit = near >= 0
            parts.append(pd.DataFrame({
                "query": np.repeat(some["node"].to_numpy(), hit.sum(axis=1)), "node": names[near[hit]],
                "point": ids[near[hit]], "score": exact[hit],
            }))
        return pd.concat(parts, ignore_index=True)

    return search
