"""Approximate nearest neighbours by inner product, on robust-pruned directed graphs.

Equal vectors are one node. Nodes are dealt into shards of bounded size, and each
shard gets a graph: greedy searches from fixed entries propose neighbours for a node,
pruning keeps the nearest and drops those that are nearer, by a factor alpha, to a
neighbour already kept, and edges are added both ways. A query runs a beam search in
every shard; the best of all shards are its answer. Vectors get one more coordinate
that makes them equally long, so the nearest is the one of largest inner product.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.lineage import scratch_path, written_once
from . import common
from .folder import Folder

#: Nodes in a shard, about.
SHARD_NODES = 8192
#: Edges of a node, length of the beam when a graph is built and when it is searched.
DEGREE, BUILD_BEAM, SEARCH_BEAM = 48, 64, 256
ALPHA = 1.2
#: Searches that run side by side in numpy.
TOGETHER = 256


def lengthened(x: np.ndarray) -> np.ndarray:
    """Rows with a last coordinate that makes all as long as the longest."""
    square = (x.astype(np.float64) ** 2).sum(axis=1)
    return np.concatenate([x, np.sqrt(np.maximum(square.max() - square, 0))[:, None]], axis=1).astype(np.float32)


def entries(n: int, many: int = 32) -> np.ndarray:
    """Nodes that every search starts from: all of a small shard."""
    return np.arange(n) if n <= BUILD_BEAM else np.unique(np.random.default_rng(n).integers(0, n, many))


def beam_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the `beam` nearest nodes found, nearest first, and half their squared distance less the query's own part.

    graph: neighbours of each node, -1 for none. All queries take a step at a time.
    """
    b, n = len(queries), len(x)
    half = (x.astype(np.float64) ** 2).sum(axis=1).astype(np.float32) / 2
    first = entries(n)
    beam = min(beam, n)
    width = max(beam, len(first))
    rows = np.arange(b)[:, None]
    ids = np.full((b, width), -1, np.int64)
    far = np.full((b, width), np.inf, np.float32)
    ids[:, : len(first)] = first
    far[:, : len(first)] = half[first] - queries @ x[first].T
    seen = np.zeros((b, n + 1), bool)
    seen[:, first] = True
    seen[:, n] = True
    order = np.argsort(far, axis=1, kind="stable")
    ids, far = np.take_along_axis(ids, order, 1)[:, :beam], np.take_along_axis(far, order, 1)[:, :beam]
    done = ids < 0
    live = np.arange(b)
    while len(live):
        todo = np.where(done[live], np.inf, far[live])
        pick = np.argsort(todo, axis=1)[:, :2]
        ready = np.isfinite(np.take_along_axis(todo, pick, 1))
        live, pick, ready = live[ready[:, 0]], pick[ready[:, 0]], ready[ready[:, 0]]
        if not len(live):
            break
        r = live[:, None]
        node = np.where(ready, ids[r, pick], -1)
        done[r, pick] |= ready
        near = np.where(node[:, :, None] >= 0, graph[node], -1).reshape(len(live), -1)
        near = np.where(near < 0, n, near)
        new = ~seen[r, near]
        seen[r, near] = True
        near = np.where(new, near, -1)
        # one node may come from both picks
        order = np.argsort(near, axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        dist = np.where(near >= 0, half[near] - np.einsum("brd,bd->br", x[near], queries[live]), np.inf).astype(np.float32)
        ids2, far2 = np.concatenate([ids[live], near], axis=1), np.concatenate([far[live], dist], axis=1)
        done2 = np.concatenate([done[live], near < 0], axis=1)
        order = np.argsort(far2, axis=1, kind="stable")[:, :beam]
        ids[live], far[live], done[live] = (np.take_along_axis(a, order, 1) for a in (ids2, far2, done2))
    del rows
    return ids, far


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """At most `degree` of each node's candidates (-1: none): the nearest, again and again, without those that it covers."""
    own = x[nodes]
    points = x[candidates]
    dist = ((points - own[:, None, :]) ** 2).sum(axis=2)
    dist[(candidates < 0) | (candidates == nodes[:, None])] = np.inf
    order = np.argsort(dist, axis=1, kind="stable")
    candidates, dist, points = np.take_along_axis(candidates, order, 1), np.take_along_axis(dist, order, 1), np.take_along_axis(points, order[:, :, None], 1)
    candidates, dist, points = candidates[:, : 3 * degree], dist[:, : 3 * degree], points[:, : 3 * degree]
    alive = np.isfinite(dist)
    alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    square = (points**2).sum(axis=2)
    out = np.full((len(nodes), degree), -1, np.int64)
    rows = np.arange(len(nodes))
    for k in range(degree):
        pick = alive.argmax(axis=1)
        some = alive[rows, pick]
        if not some.any():
            break
        out[some, k] = candidates[rows, pick][some]
        between = square + square[rows, pick][:, None] - 2 * np.einsum("bcd,bd->bc", points, points[rows, pick])
        alive &= alpha * alpha * np.maximum(between, 0) > dist
        alive[rows, pick] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 0) -> np.ndarray:
    """Neighbours of each row of x, -1 for none; two rounds of inserts over all rows, the second with alpha."""
    n = len(x)
    rng = np.random.default_rng(seed)
    graph = np.full((n, degree), -1, np.int64)
    if n < 2:
        return graph
    few = min(degree // 2, n - 1)
    graph[:, :few] = (np.arange(n)[:, None] + 1 + rng.integers(0, n - 1, (n, few))) % n
    for a in (1.0, alpha):
        for nodes in np.array_split(rng.permutation(n), -(-n // TOGETHER)):
            found, _ = beam_search(x, graph, x[nodes], beam)
            graph[nodes] = robust_prune(x, nodes, np.concatenate([found, graph[nodes]], axis=1), degree, a)
            source, target = np.repeat(nodes, degree), graph[nodes].ravel()
            source, target = source[target >= 0], target[target >= 0]
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            ends, start, count = np.unique(target, return_index=True, return_counts=True)
            place = np.arange(len(target)) - np.repeat(start, count)
            back = np.full((len(ends), int(count.max()) if len(count) else 0), -1, np.int64)
            back[np.repeat(np.arange(len(ends)), count), place] = source
            back[(back[:, :, None] == graph[ends][:, None, :]).any(axis=2)] = -1
            room = (graph[ends] < 0).sum(axis=1)
            wanted = (back >= 0).sum(axis=1)
            fits = wanted <= room
            both = np.concatenate([graph[ends], back], axis=1)
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
            graph[ends[fits]] = packed[fits, :degree]
            full = np.flatnonzero(~fits)
            for some in np.array_split(full, -(-len(full) // TOGETHER)) if len(full) else []:
                graph[ends[some]] = robust_prune(x, ends[some], both[some], degree, a)
    return graph


def usable(vector: Column, size: int) -> Column:
    """Whether a vector takes part: `size` finite components, not all zero."""
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) == size) & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (vec_id, vector) that take part; the dimension is the most frequent one, ties to the larger."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("vector")).where("vec_id IS NOT NULL")
    size = rows.where(F.size("vector") > 0).groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(usable(F.col("vector"), size["d"] if size else 0))


def build_index(rows: DataFrame, uri: str, k: int) -> list[tuple[int, int]]:
    """Write a graph for each shard of the distinct vectors; (shard, nodes) of each.

    Of the ids of one vector the k + 1 smallest are kept: no answer of k names others.
    """
    by = Window.partitionBy("vector").orderBy("vec_id")
    rows = rows.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= k + 1)
    nodes = written_once(rows.groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("members")))
    shards = 1 + (nodes.count() - 1) // SHARD_NODES

    def build(pdf):
        import pandas as pd

        pdf = pdf.sort_values("first")
        raw = np.stack(pdf["vector"].to_numpy()).astype(np.float32)
        x = lengthened(raw)
        graph = build_graph(x)
        shard, folder = int(pdf["shard"].iloc[0]), Folder(uri)
        members = [np.asarray(m, dtype=np.int64) for m in pdf["members"]]
        folder.write(f"{shard:06d}.x", x)
        folder.write(f"{shard:06d}.graph", graph.astype(np.int32))
        folder.write(f"{shard:06d}.members", np.concatenate(members))
        folder.write(f"{shard:06d}.ends", np.cumsum([len(m) for m in members]).astype(np.int64))
        return pd.DataFrame({"shard": [shard], "nodes": [len(x)]})

    dealt = nodes.select(F.pmod(F.xxhash64(F.col("members")[0]), F.lit(max(1, shards))).cast("int").alias("shard"), F.col("members")[0].alias("first"), "vector", "members")
    # one short row for each shard comes to the driver
    return sorted((r["shard"], r["nodes"]) for r in dealt.groupBy("shard").applyInPandas(build, "shard int, nodes int").collect())


_open: dict[tuple[str, int], tuple] = {}


def opened(uri: str, shard: int, nodes: int) -> tuple:
    """Vectors, graph, members and their ends of a shard, mapped once in a worker."""
    if (uri, shard) not in _open:
        folder = Folder(uri)
        _open[uri, shard] = (folder.map(f"{shard:06d}.x", np.float32).reshape(nodes, -1), folder.map(f"{shard:06d}.graph", np.int32).reshape(nodes, -1), folder.map(f"{shard:06d}.members", np.int64), folder.map(f"{shard:06d}.ends", np.int64))
    return _open[uri, shard]


def nearest(table: DataFrame, queries: Column, k: int = 20, uri: str | None = None, id_col: str = "vec_id", vector_col: str = "embedding", beam: int = SEARCH_BEAM) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row where `queries` holds, its k nearest other rows by inner product.

    score is the inner product of the original vectors in double precision; ranks
    follow it, ties go to the smaller id. Vectors that are null, zero, of another
    dimension or with null or non-finite components, and null ids, take no part. A
    query with fewer than k candidates gets all. Rows that repeat an id and vector are
    one candidate. The index is in `uri`, else in a new folder of spark.checkpoint.dir.
    """
    spark = table.sparkSession
    common.ship(spark)
    uri = uri or scratch_path(spark)
    shards = build_index(vectors(table, id_col, vector_col), uri, k)
    sizes = dict(shards)
    asked = vectors(table.where(queries), id_col, vector_col).dropDuplicates(["vec_id"]) if shards else vectors(table.where(queries), id_col, vector_col)
    schema = "query_id long, vec_id long, score double"

    def search(batches):
        import pyarrow as pa

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            who = batch.column("vec_id").to_numpy()
            q = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(batch.num_rows, -1)
            for s in np.unique(shard):
                x, graph, members, ends = opened(uri, int(s), sizes[int(s)])
                here = np.flatnonzero(shard == s)
                for at in np.array_split(here, -(-len(here) // TOGETHER)):
                    long = np.concatenate([q[at], np.zeros((len(at), 1), np.float32)], axis=1)
                    found, _ = beam_search(x, graph, long, max(beam, k + 1))
                    out = []
                    for i, nodes in zip(at, found):
                        nodes = nodes[nodes >= 0]
                        score = (x[nodes, :-1].astype(np.float64) * q[i].astype(np.float64)).sum(axis=1)
                        best = np.argsort(-score, kind="stable")[: k + 1]
                        # equal scores at the border: all of them, so that the smaller id can win
                        nodes, score = nodes[score >= score[best[-1]]], score[score >= score[best[-1]]]
                        ids = np.concatenate([members[(ends[v - 1] if v else 0) : ends[v]] for v in nodes])
                        score = np.repeat(score, [ends[v] - (ends[v - 1] if v else 0) for v in nodes])
                        score, ids = score[ids != who[i]], ids[ids != who[i]]
                        top = np.lexsort((ids, -score))[:k]
                        out.append((np.full(len(top), who[i]), ids[top], score[top]))
                    yield pa.record_batch([pa.array(np.concatenate([o[j] for o in out])) for j in range(3)], names=["query_id", "vec_id", "score"])

    if not shards:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # every query meets every shard; tasks take blocks of queries of one shard
    listed = F.array(*[F.lit(s) for s, _ in shards]).cast("array<int>")
    meet = asked.withColumn("shard", F.explode(listed)).withColumn("_block", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)))
    meet = meet.repartitionByRange("shard", "_block").sortWithinPartitions("shard", "_block").select("shard", "vec_id", "vector")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = meet.mapInArrow(search, schema).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
