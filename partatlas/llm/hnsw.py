"""Nearest neighbours by inner product: one navigable small-world graph per shard.

Equal vectors are one point with its smallest ids, as many as an answer can need, so
that a vector that a third of the rows share is neither a dense spot in a graph nor a
group in one task. Points are dealt to shards of about ``SHARD_POINTS`` by a hash. A
shard's hierarchical graph is built with NumPy and stored as one row of flat arrays:
vectors, levels, and for every layer the neighbour numbers, a fixed number per point.
Points get one more coordinate that makes their lengths equal, so that the largest
inner product with a query is the smallest distance.

Insertion and search go through the same beam search, which advances many beams at
once. Points enter a graph in batches against the graph so far and are linked to each
other too. Every shard answers every query block, a task at a time holds one graph and
one block, and the shards' answers are merged by exact inner products, in double
precision over the original vectors, ties to the smaller id.

Vectors that are null, zero or hold null or non-finite components take no part, and
neither do null ids or vectors of another length than the most frequent one. Repeated
ids are rows of their own, as candidates and as queries; a query's answers come once
for each of its rows. An empty table gives no rows.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partatlas.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K = 20
SHARD_POINTS = 1 << 13
QUERY_BLOCK = 1 << 11
#: Neighbours of a point on upper layers (twice as many on the lowest), and beam widths.
LINKS = 16
BUILD_BEAM = 64
SEARCH_BEAM = 128
_BATCH = 256
_GRAPH = "shard int, points int, dims int, vectors binary, levels binary, layers array<binary>, entry int"


def _beam(vectors, links, queries, starts, width, hops=10_000):
    """Best ``width`` points (numbers and scores, best first; -1: none) for each query.

    ``links`` has a row of neighbour numbers (-1: none) for each point, ``starts`` a
    row of distinct points to set out from for each query.
    """
    n, m = len(vectors), len(queries)
    if not m:
        return np.zeros((0, width), np.int64), np.zeros((0, width), np.float32)
    ids = np.full((m, width), -1, np.int64)
    scores = np.full((m, width), -np.inf, np.float32)
    k = min(starts.shape[1], width)
    ids[:, :k] = starts[:, :k]
    scores[:, :k] = np.where(ids[:, :k] >= 0, np.einsum("mkd,md->mk", vectors[ids[:, :k]], queries), -np.inf)
    open_ = ids >= 0
    seen = np.zeros((m, n), bool)
    r, c = np.nonzero(open_)
    seen[r, ids[r, c]] = True
    for _ in range(hops):
        best = np.where(open_, scores, -np.inf)
        at = best.argmax(1)
        live = np.flatnonzero(best[np.arange(m), at] > -np.inf)
        if not len(live):
            break
        at = at[live]
        open_[live, at] = False
        near = links[ids[live, at]]
        fresh = near >= 0
        fresh &= ~seen[live[:, None], np.maximum(near, 0)]
        r, c = np.nonzero(fresh)
        if not len(r):
            continue
        found = near[r, c]
        # A row's neighbours are distinct, so no point is met twice here.
        seen[live[r], found] = True
        value = np.full(near.shape, -np.inf, np.float32)
        value[r, c] = np.einsum("id,id->i", vectors[found], queries[live[r]])
        every = np.concatenate([scores[live], value], 1)
        which = np.concatenate([ids[live], np.where(fresh, near, -1)], 1)
        fresh_open = np.concatenate([open_[live], fresh], 1)
        keep = np.argpartition(-every, width - 1, 1)[:, :width]
        scores[live] = np.take_along_axis(every, keep, 1)
        ids[live] = np.take_along_axis(which, keep, 1)
        open_[live] = np.take_along_axis(fresh_open, keep, 1) & (scores[live] > -np.inf)
    order = np.argsort(-scores, 1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def _diverse(vectors, point, candidates, limit):
    """Up to ``limit`` candidates (best first), those nearer to the point than to any
    chosen one first, the nearest others after them."""
    v = vectors[candidates]
    to_point = v @ vectors[point]
    between = v @ v.T
    chosen, left = [], []
    for i in range(len(candidates)):
        if len(chosen) == limit:
            break
        if all(between[i, j] < to_point[i] for j in chosen):
            chosen.append(i)
        else:
            left.append(i)
    return candidates[(chosen + left)[:limit]]


def build(vectors: np.ndarray, seed: int) -> dict:
    """Graph of a shard's points; ``layers[l]`` has the links of layer ``l``."""
    n = len(vectors)
    norms = np.einsum("id,id->i", vectors, vectors, dtype=np.float64)
    rest = np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))
    points = np.concatenate([vectors, rest[:, None]], 1).astype(np.float32)
    rng = np.random.default_rng(seed)
    levels = np.minimum((-np.log(1 - rng.random(n)) / math.log(LINKS)).astype(np.int64), 12)
    order = np.argsort(-levels, kind="stable")  # points of upper layers enter first
    top = int(levels.max(initial=0))
    layers = [np.full((n, LINKS * (2 if lev == 0 else 1)), -1, np.int32) for lev in range(top + 1)]
    entry = int(order[0]) if n else -1

    def link(layer: np.ndarray, point: int, candidates: np.ndarray) -> None:
        chosen = _diverse(points, point, candidates, layer.shape[1])
        layer[point, : len(chosen)] = chosen
        layer[point, len(chosen) :] = -1
        for other in chosen.tolist():
            row = layer[other]
            if (row == point).any():
                continue
            free = np.flatnonzero(row < 0)
            if len(free):
                row[free[0]] = point
            else:
                pool = np.append(row, point).astype(np.int64)
                pool = pool[np.argsort(-(points[pool] @ points[other]), kind="stable")]
                row[:] = _diverse(points, other, pool, len(row))

    done, size = 1, 1
    while done < n:
        # Batches no larger than the graph so far.
        size = min(_BATCH, done, n - done)
        batch = order[done : done + size]
        starts = np.full((size, 1), entry, np.int64)
        for lev in range(top, -1, -1):
            inside = levels[batch] >= lev
            if inside.any():
                found, _ = _beam(points, layers[lev], points[batch[inside]], starts[inside], BUILD_BEAM)
                members = batch[inside]
                among = points[members] @ points[members].T
                for row, point in enumerate(members.tolist()):
                    pool = np.concatenate([found[row][found[row] >= 0], members[np.argsort(-among[row])[: LINKS + 1]]])
                    pool = np.unique(pool[pool != point])
                    pool = pool[np.argsort(-(points[pool] @ points[point]), kind="stable")][:BUILD_BEAM]
                    link(layers[lev], point, pool)
                wide = np.full((size, BUILD_BEAM), -1, np.int64)
                wide[inside] = found
                below, _ = _beam(points, layers[lev], points[batch[~inside]], starts[~inside], 1)
                wide[~inside, :1] = below
                starts = wide
            else:
                starts, _ = _beam(points, layers[lev], points[batch], starts, 1)
        done += size
    return {"points": points, "levels": levels.astype(np.int8), "layers": layers, "entry": entry}


def search(vectors: np.ndarray, layers: list[np.ndarray], entry: int, queries: np.ndarray, k: int):
    """Best ``k`` points of a graph for each query: numbers (-1: none)."""
    starts = np.full((len(queries), 1), entry, np.int64)
    for layer in reversed(layers[1:]):
        starts, _ = _beam(vectors, layer, queries, starts, 1)
    found, _ = _beam(vectors, layers[0], queries, starts, max(SEARCH_BEAM, 2 * k))
    return found[:, :k]


def valid_vectors(table: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` (float) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    ok = F.col("vec_id").isNotNull() & vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = table.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("embedding"))
    dims = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("embedding") == (dims["d"] if dims else 0))


def points_of(rows: DataFrame, k: int = K) -> DataFrame:
    """Distinct vectors with the smallest ``k + 1`` of their ids, an id as often as its
    rows, ``k`` times at most."""
    # Rows that repeat an id are counted, so that its own ones take no other's place.
    distinct = rows.groupBy("embedding", "vec_id").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    # Ranks are cut below the shuffle, so equal vectors do not meet in one task.
    few = distinct.select("*", rank.alias("rank")).filter(F.col("rank") <= k + 1)
    times = F.array_repeat("vec_id", F.least("n", F.lit(k)).cast("int"))
    return few.groupBy("embedding").agg(F.sort_array(F.flatten(F.collect_list(times))).alias("ids"))


def build_index(points: DataFrame, n_shards: int) -> DataFrame:
    """One row of flat arrays per shard; ``shard`` and ``place`` name a point."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        shard = int(pdf["shard"].iloc[0])
        g = build(np.stack(pdf["embedding"].to_numpy()).astype(np.float32), shard)
        return pd.DataFrame([{
            "shard": shard, "points": len(pdf), "dims": g["points"].shape[1], "vectors": g["points"].tobytes(),
            "levels": g["levels"].tobytes(), "layers": [x.tobytes() for x in g["layers"]], "entry": g["entry"]}])

    return points.select("shard", "place", "embedding").repartition(n_shards, "shard").groupBy("shard").applyInPandas(
        run, _GRAPH)


def nearest(table: DataFrame, k: int = K, every: int = 20) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest candidates found
    for each row whose ``vec_id`` is divisible by ``every``, its own row left out."""
    rows = materialize(valid_vectors(table.select("vec_id", "embedding")), "vectors")
    distinct = materialize(points_of(rows, k), "points")
    n_shards = max(1, -(-distinct.count() // SHARD_POINTS))
    shard = F.pmod(F.xxhash64("embedding"), F.lit(n_shards)).cast("int")
    place = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("embedding"), "embedding")) - 1
    points = materialize(distinct.select("*", shard.alias("shard")).select("*", place.alias("place")), "shard-points")
    graphs = materialize(build_index(points, n_shards), "graphs")

    # Rows that repeat a query are asked once; each of them gets the answers.
    asked = materialize(rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id", "embedding").agg(
        F.count("*").cast("int").alias("copies")), "queries")
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    shards = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard")
    queries = asked.select(
        F.col("vec_id").alias("query_id"), "embedding", "copies", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n_blocks)).cast("int").alias("block"))

    def run(graph: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if graph.empty or asking.empty:
            return pd.DataFrame({"query_id": [], "embedding": [], "copies": [], "shard": [], "place": []})
        g = graph.iloc[0]
        vectors = np.frombuffer(g["vectors"], np.float32).reshape(g["points"], g["dims"])
        layers = [np.frombuffer(x, np.int32).reshape(g["points"], -1) for x in g["layers"]]
        q = np.stack(asking["embedding"].to_numpy()).astype(np.float32)
        q = np.concatenate([q, np.zeros((len(q), 1), np.float32)], 1)
        found = np.concatenate([search(vectors, layers, int(g["entry"]), q[i : i + _BATCH], k + 1)
                                for i in range(0, len(q), _BATCH)])
        r, c = np.nonzero(found >= 0)
        return pd.DataFrame({
            "query_id": asking["query_id"].to_numpy()[r], "embedding": asking["embedding"].to_numpy()[r],
            "copies": asking["copies"].to_numpy()[r],
            "shard": g["shard"], "place": found[r, c]})

    found = graphs.select("*", blocks).groupBy("shard", "block").cogroup(
        queries.select("*", shards).groupBy("shard", "block")).applyInPandas(
        run, "query_id long, embedding array<double>, copies int, shard int, place int")
    pairs = found.join(points.select("shard", "place", F.col("embedding").alias("point"), "ids"), ["shard", "place"])
    score = F.aggregate(F.zip_with("embedding", "point", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    scored = pairs.select("query_id", "embedding", "copies", score.alias("score"), F.explode("ids").alias("vec_id")).filter(
        "vec_id <> query_id")
    best = Window.partitionBy("query_id", "embedding").orderBy(F.desc("score"), "vec_id")
    ranked = scored.select("*", F.row_number().over(best).alias("rank")).filter(F.col("rank") <= k)
    return ranked.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
