"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logpulse.llm.common import stored


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its tree) that connect what the given edges connect."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = index[: len(a)].tolist(), index[len(a) :].tolist()
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(left, right):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.array([root(x) for x in range(len(nodes))], np.int64)
    moved = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[moved], nodes[roots[moved]]


def _star(edges: DataFrame, *, large: bool) -> DataFrame:
    """Link each node's larger (or smaller) neighbours to the smallest node it sees."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        linked = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        linked = down.join(least, "a").select("b", "m").union(least.select(F.col("a").alias("b"), "m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b), two columns of type long, except roots.

    The root is the smallest node of a component. Each round is written to the shared folder. Stars
    only look at a node's smallest neighbour, by an aggregate that is combined in each map task, so
    a node with very many edges is not gathered anywhere. An empty edge table gives an empty result.
    """
    edges = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or not state["n"]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
