"""Approximate nearest neighbours by inner product: one navigable small-world graph per shard, results merged.

Equal vectors are one node that remembers its smallest identifiers, so a vector that many rows share cannot crowd a graph.
Nodes are dealt to shards of a bounded size; each shard's graph is built by one task and kept as flat arrays: vectors, levels
and a fixed number of neighbour slots per node and level. Queries go to every shard in blocks, and the shards' best are
merged. Vectors get one more component that gives all the same norm, which turns the largest inner product into the nearest
point; queries have 0 there.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parts_for, stored

SHARD, QUERY_BLOCK = 8192, 2048
SLOTS, EF_BUILD, EF_SEARCH = 16, 64, 128


class Graph:
    """Flat arrays: ``vectors`` n x d, ``links[level]`` n x slots (level 0 has twice as many), ``counts[level]``, ``entry``."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], counts: list[np.ndarray], entry: int):
        self.vectors, self.links, self.counts, self.entry = vectors, links, counts, entry
        self.seen, self.stamp = np.zeros(len(vectors), np.int64), 0

    @classmethod
    def build(cls, points: np.ndarray, slots: int = SLOTS, ef: int = EF_BUILD, seed: int = 0) -> Graph:
        n = len(points)
        norms = (points.astype(np.float64) ** 2).sum(1)
        extra = np.sqrt(np.maximum(0, norms.max(initial=0) - norms))
        vectors = np.ascontiguousarray(np.c_[points, extra], np.float32)
        levels = np.minimum(np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(slots)).astype(int), 8)
        top = int(levels.max(initial=0))
        graph = cls(vectors, [np.zeros((n, slots * (2 if k == 0 else 1)), np.int32) for k in range(top + 1)],
                    [np.zeros(n, np.int32) for _ in range(top + 1)], 0)
        near = [np.full(x.shape, -np.inf, np.float32) for x in graph.links]  # the links' similarities, while building
        height = int(levels[0]) if n else 0
        for node in range(1, n):
            point, at = vectors[node], [(0.0, graph.entry)]
            for level in range(height, -1, -1):
                at = graph.nearest(point, at, 1 if level > levels[node] else ef, level)
                if level <= levels[node]:
                    for sim, other in graph.spread(at, slots):
                        graph.link(near, level, node, other, sim)
                        graph.link(near, level, other, node, sim)
            if levels[node] > height:
                height, graph.entry = int(levels[node]), node
        return graph

    def link(self, near: list[np.ndarray], level: int, a: int, b: int, sim: float) -> None:
        count, links = self.counts[level], self.links[level]
        if count[a] < links.shape[1]:
            at = count[a]
            count[a] += 1
        else:  # the worst link of a full node makes room, or the new one is not made
            at = int(near[level][a].argmin())
            if near[level][a, at] >= sim:
                return
        links[a, at], near[level][a, at] = b, sim

    def spread(self, found: list[tuple[float, int]], slots: int) -> list[tuple[float, int]]:
        """The nearest, leaving out what is nearer to one already chosen; then filled up with the nearest left out."""
        if len(found) <= 1:
            return found
        nodes = np.array([x for _, x in found])
        among = self.vectors[nodes] @ self.vectors[nodes].T
        blocked, chosen = np.zeros(len(nodes), bool), []
        sims = np.array([s for s, _ in found], np.float32)
        for k in range(len(nodes)):
            if not blocked[k]:
                chosen.append(k)
                if len(chosen) == slots:
                    break
                blocked |= among[k] > sims
        rest = [k for k in range(min(len(nodes), slots)) if blocked[k] and k not in chosen]
        return [found[k] for k in (chosen + rest)[:slots]]

    def nearest(self, point: np.ndarray, start: list[tuple[float, int]], ef: int, level: int) -> list[tuple[float, int]]:
        """The ``ef`` nearest found from ``start``, nearest first."""
        self.stamp += 1
        links, counts, seen, vectors, stamp = self.links[level], self.counts[level], self.seen, self.vectors, self.stamp
        nodes = np.array([x for _, x in start])
        seen[nodes] = stamp
        best = list(zip((vectors[nodes] @ point).tolist(), nodes.tolist(), strict=True))
        heapq.heapify(best)
        open_ = [(-s, x) for s, x in best]
        heapq.heapify(open_)
        while open_:
            sim, node = heapq.heappop(open_)
            if len(best) >= ef and -sim < best[0][0]:
                break
            row = links[node, :counts[node]]
            row = row[seen[row] != stamp]
            if not len(row):
                continue
            seen[row] = stamp
            sims = vectors[row] @ point
            if len(best) >= ef:
                better = sims > best[0][0]
                row, sims = row[better], sims[better]
            for s, x in zip(sims.tolist(), row.tolist(), strict=True):
                if len(best) < ef:
                    heapq.heappush(best, (s, x))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, x))
                else:
                    continue
                heapq.heappush(open_, (-s, x))
        return sorted(best, reverse=True)

    def search(self, query: np.ndarray, ef: int) -> list[int]:
        point = np.r_[query, 0].astype(np.float32)
        at = [(0.0, self.entry)]
        for level in range(len(self.links) - 1, -1, -1):
            at = self.nearest(point, at, 1 if level else ef, level)
        return [x for _, x in at]

    def to_bytes(self, **more: np.ndarray) -> bytes:
        out = io.BytesIO()
        flat = {f"links{k}": x for k, x in enumerate(self.links)} | {f"counts{k}": x for k, x in enumerate(self.counts)}
        np.savez(out, vectors=self.vectors, entry=np.array(self.entry), **flat, **more)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[Graph, dict[str, np.ndarray]]:
        arrays = dict(np.load(io.BytesIO(data)))
        height = sum(k.startswith("links") for k in arrays)
        return cls(arrays["vectors"], [arrays[f"links{k}"] for k in range(height)],
                   [arrays[f"counts{k}"] for k in range(height)], int(arrays["entry"])), arrays


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def build_index(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 20,
                shard: int = SHARD, slots: int = SLOTS, ef: int = EF_BUILD) -> DataFrame:
    """One row per shard: dim, shard, graph (binary). Every usable row is indexed; its table is kept in the shared folder."""
    rows = vectors.where(F.col(vec_id).isNotNull() & usable(F.col(embedding))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<float>").alias("v")).distinct()
    place = Window.partitionBy("v").orderBy("vec_id")
    nodes = (rows.withColumn("turn", F.row_number().over(place)).where(F.col("turn") <= k + 1)
             .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    nodes = stored(nodes.withColumn("dim", F.size("v")), "vectors")
    n_shards = parts_for(nodes.count(), shard)
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(n_shards)))

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.iloc[np.argsort([x[0] for x in frame["ids"]], kind="stable")]
        points = np.stack([np.asarray(x, np.float32) for x in frame["v"]])
        lengths = np.array([len(x) for x in frame["ids"]])
        graph = Graph.build(points, slots, ef, int(key[1]))
        data = graph.to_bytes(ids=np.concatenate([np.asarray(x, np.int64) for x in frame["ids"]]), ends=np.cumsum(lengths))
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "graph": [data]})

    return stored(nodes.groupBy("dim", "shard").applyInPandas(build, "dim int, shard long, graph binary"), "graphs")


def search_index(index: DataFrame, queries: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 20,
                 ef: int = EF_SEARCH, block: int = QUERY_BLOCK) -> DataFrame:
    """Each query's ``k`` nearest found: query_id, rank, vec_id, score, ties to the smaller vec_id.

    A query never finds its own identifier. Rows that repeat an identifier and its vector are one query; vectors of
    different lengths are never compared; rows without an identifier and vectors that are not usable take no part. Scores
    are double-precision inner products of the original vectors. Empty tables give an empty result.
    """
    asked = queries.where(F.col(vec_id).isNotNull() & usable(F.col(embedding))).select(
        F.col(vec_id).cast("long").alias("query_id"), F.col(embedding).cast("array<float>").alias("v")).distinct()
    asked = stored(asked.withColumn("dim", F.size("v")), "queries")
    n_blocks = parts_for(asked.count(), block)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)))
    shards = index.select(F.col("dim").alias("to_dim"), F.col("shard").alias("to_shard"))
    spread = asked.join(shards, F.col("dim") == F.col("to_dim"))
    blocks = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))

    def search(graphs: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(graphs) and len(points):
            graph, more = Graph.from_bytes(graphs["graph"].iloc[0])
            ids, ends = more["ids"], more["ends"]
            starts = np.r_[0, ends[:-1]]
            for query_id, v in zip(points["query_id"].tolist(), points["v"], strict=True):
                query = np.asarray(v, np.float32)
                found = np.array(graph.search(query, max(ef, k + 1)))[:k + 1]
                scores = graph.vectors[found, :-1].astype(np.float64) @ query.astype(np.float64)
                each = np.repeat(scores, ends[found] - starts[found])
                theirs = np.concatenate([ids[starts[x]:ends[x]] for x in found.tolist()])
                each, theirs = each[theirs != query_id], theirs[theirs != query_id]
                best = np.lexsort((theirs, -each))[:k]
                out.append(pd.DataFrame({"query_id": query_id, "vec_id": theirs[best], "score": each[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = (blocks.groupBy("dim", "shard", "block").cogroup(spread.groupBy("to_dim", "to_shard", "block"))
             .applyInPandas(search, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
