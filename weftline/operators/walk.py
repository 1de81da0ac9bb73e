"""Random walks on a weighted graph: first order (DeepWalk) and second order (node2vec).

The draw of a hop depends only on (seed, walk, start, step), so the two ways of
walking give the same paths and do not depend on partitions: a small graph is
broadcast and whole paths are walked in one stage; any other is walked hop by
hop, each hop one join of the walkers with the adjacency lists.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import hash_uniform
from ..session import cut
from .sampling import neighbour_lists

#: Graphs of at most this many edges are broadcast (a few ten MB); the edges are counted first.
BROADCAST_EDGES = 500_000
#: Hops between two cuts of the lineage.
CUT_EVERY = 10
#: Weights that a step over a broadcast graph looks at at once.
MOST_CELLS = 2_000_000


def _draw(seed: int, walk: int, start: str, step: int) -> float:
    return int(hashlib.md5(f"{seed}|{walk}|{start}|{step}".encode()).hexdigest()[:8], 16) / 4294967296


class _Adjacency:
    """Neighbours of all nodes in flat arrays, in order of dst; nodes are numbered in order of their names."""

    def __init__(self, lists: dict[str, tuple[list[str], np.ndarray]]):
        self.names = np.array(sorted({*lists, *(d for dsts, _ in lists.values() for d in dsts)}), dtype=object)
        number = {name: k for k, name in enumerate(self.names)}
        self.number = number
        self.degree = np.zeros(len(self.names), dtype=np.int64)
        for src, (dsts, _) in lists.items():
            self.degree[number[src]] = len(dsts)
        self.first = np.concatenate([[0], np.cumsum(self.degree)])
        self.dst, self.weight = np.zeros(self.first[-1], dtype=np.int64), np.zeros(self.first[-1])
        for src, (dsts, weights) in lists.items():
            at = self.first[number[src]]
            self.dst[at : at + len(dsts)], self.weight[at : at + len(dsts)] = [number[d] for d in dsts], weights
        src = np.repeat(np.arange(len(self.names)), self.degree)
        self.edges = np.sort(src * len(self.names) + self.dst)

    def has(self, src: np.ndarray, dst: np.ndarray) -> np.ndarray:
        wanted = src * len(self.names) + dst
        place = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
        return self.edges[place] == wanted


def _step(graph: _Adjacency, at: np.ndarray, prev: np.ndarray | None, u: np.ndarray, p: float, q: float) -> np.ndarray:
    """Where each walker goes: a row of its neighbours' weights, summed up, holds its draw somewhere."""
    out = np.empty(len(at), dtype=np.int64)
    order = np.argsort(graph.degree[at], kind="stable")  # rows of a piece are about as long as each other
    while len(order):
        # as many walkers as fill MOST_CELLS cells
        widths = graph.degree[at[order]]
        many = max(1, int(np.searchsorted(widths * np.arange(1, len(order) + 1), MOST_CELLS, side="right")))
        rows, order = order[:many], order[many:]
        own, width = at[rows], int(widths[many - 1])
        column = np.arange(width)
        inside = column < graph.degree[own][:, None]
        cell = np.minimum(graph.first[own][:, None] + column, len(graph.dst) - 1)
        weight, dst = np.where(inside, graph.weight[cell], 0.0), graph.dst[cell]
        if prev is not None:
            before = np.broadcast_to(prev[rows][:, None], dst.shape)
            weight = np.where(dst == before, weight / p, np.where(graph.has(before, dst), weight, weight / q))
        sums = np.cumsum(weight, axis=1)
        pick = np.minimum((sums <= (u[rows] * sums[:, -1])[:, None]).sum(1), graph.degree[own] - 1)
        out[rows] = dst[np.arange(len(rows)), pick]
    return out


def _walker(graph: _Adjacency, hops: int, p: float, q: float, seed: int):
    """All walkers of a batch go a step at a time, in arrays."""
    first_order = p == 1 and q == 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            walks, starts = batch["walk"].to_numpy(), batch["start"].to_numpy()
            path = np.full((len(batch), hops + 1), -1, dtype=np.int64)
            path[:, 0] = [graph.number[s] for s in starts]
            going = np.arange(len(batch))
            for step in range(hops):
                going = going[graph.degree[path[going, step]] > 0]
                if not len(going):
                    break
                u = np.array([_draw(seed, walks[k], starts[k], step) for k in going.tolist()])
                prev = path[going, step - 1] if step and not first_order else None
                path[going, step + 1] = _step(graph, path[going, step], prev, u, p, q)
            yield batch[["walk", "start"]].assign(path=[graph.names[row[: n + 1]].tolist() for row, n in zip(path, (path >= 0).sum(1) - 1)])

    return run


def _hop_by_hop(starts: DataFrame, adjacency: DataFrame, hops: int, p: float, q: float, seed: int) -> DataFrame:
    lists = adjacency.select(F.col("src").alias("at"), "nbrs")
    walkers = starts.select("walk", "start", F.array("start").alias("path"), F.lit(None).cast("array<string>").alias("known"), F.col("start").alias("at"))
    for step in range(hops):
        met = walkers.join(lists, "at", "left")
        if p == 1 and q == 1 or step == 0:
            weights = F.expr("transform(nbrs, x -> x.weight)")
        else:
            weights = F.expr(f"transform(nbrs, x -> CASE WHEN x.dst = element_at(path, -2) THEN x.weight / {float(p)}D WHEN array_contains(known, x.dst) THEN x.weight ELSE x.weight / {float(q)}D END)")
        met = met.withColumn("ws", weights).withColumn("u", hash_uniform(seed, F.col("walk"), F.col("start"), step) * F.expr("aggregate(ws, 0D, (s, x) -> s + x)"))
        passed = F.expr("aggregate(ws, struct(0D AS s, 0 AS k), (a, x) -> struct(a.s + x AS s, if(a.s + x <= u, a.k + 1, a.k) AS k), a -> a.k)")
        pick = F.least(passed + 1, F.size("nbrs"))
        dst = F.when(F.size("nbrs") > 0, F.element_at("nbrs", pick)["dst"])
        walkers = met.withColumn("to", dst).select(
            "walk", "start", F.when(F.col("to").isNull(), F.col("path")).otherwise(F.concat("path", F.array("to"))).alias("path"),
            F.expr("transform(nbrs, x -> x.dst)").alias("known"), F.coalesce("to", F.concat(F.lit("\0"), "start")).alias("at"),  # a walk that ended looks for no node, and is spread by its start
        )
        if (step + 1) % CUT_EVERY == 0:
            walkers = cut(walkers)
    return walkers.select("walk", "start", "path")


def random_walks(
    graph: DataFrame, num_walks: int = 10, walk_length: int = 80, p: float = 1.0, q: float = 1.0, seed: int = 7, exact_nodes: bool = False, sinks: bool = False, broadcast_edges: int = BROADCAST_EDGES
) -> DataFrame:
    """``walk`` (from 0), ``start``, ``path`` (array<string>) of every node with out-edges, ``num_walks`` times.

    A path has up to ``walk_length`` + 2 nodes (start, first hop and
    ``walk_length`` further ones), or exactly up to ``walk_length`` with
    ``exact_nodes``; it ends early in a node without out-edges. ``sinks`` starts
    walks there too. An empty graph has no walks.
    """
    hops = walk_length - 1 if exact_nodes else walk_length + 1
    nodes = graph.select(F.col("src").alias("start"))
    if sinks:
        nodes = nodes.union(graph.select("dst"))
    starts = nodes.distinct().select(F.explode(F.sequence(F.lit(0), F.lit(num_walks - 1))).alias("walk"), "start")
    adjacency = neighbour_lists(graph)
    if graph.count() <= broadcast_edges:
        lists = {r.src: ([x.dst for x in r.nbrs], np.array([x.weight for x in r.nbrs])) for r in adjacency.collect()}
        return starts.repartition("walk", "start").mapInPandas(_walker(_Adjacency(lists), hops, p, q, seed), "walk int, start string, path array<string>")
    return _hop_by_hop(starts, cut(adjacency), hops, p, q, seed)


def deepwalk(graph: DataFrame, num_walks: int = 10, walk_length: int = 80, seed: int = 7, **more) -> DataFrame:
    """First-order walks: :func:`random_walks` with p = q = 1."""
    return random_walks(graph, num_walks, walk_length, 1.0, 1.0, seed, **more)
