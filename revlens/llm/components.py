"""Distributed connected components: contraction rounds until one bounded task can finish.

Each round maps every node to the smallest of itself and its neighbours, relabels the edges and drops loops and
repeats. Even rounds compare ids, which folds a star around its smallest node at once; odd rounds compare hashes,
which shrinks any graph by a constant share, long chains too. A round is an aggregate with a map-side combine and
two joins that can be split at a hot node; the edges of a round lie on shared storage. When at most
``EDGES_PER_TASK`` edges (16 bytes each) are left, one task labels them; that bound doesn't grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import stored

EDGES_PER_TASK = 1_000_000


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges and for each the smallest node of its component."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    parent = np.arange(len(nodes))
    while True:
        low = np.minimum(parent[a], parent[b])
        new = parent.copy()
        for end in (a, b):
            np.minimum.at(new, end, low)
            np.minimum.at(new, parent[end], low)
        new = new[new]
        if np.array_equal(new, parent):
            return nodes, nodes[parent]
        parent = new


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if parts:
        nodes, roots = smallest_reachable(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["node", "to"])


def _contracted(left: DataFrame, even: bool, seed: int) -> tuple[DataFrame, DataFrame]:
    """Where each node goes in a round, and the edges after it."""

    def rank(node):
        return F.struct((node if even else F.xxhash64(F.lit(seed), node)).alias("k"), node.alias("id"))

    both = left.unionAll(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.groupBy(F.col("u").alias("node")).agg(F.min(rank(F.col("v"))).alias("near"))
    step = stored(near.select("node", F.least(F.col("near"), rank(F.col("node")))["id"].alias("to")))
    moved = left.join(step.select(F.col("node").alias("u"), F.col("to").alias("to_u")), "u").join(
        step.select(F.col("node").alias("v"), F.col("to").alias("to_v")), "v"
    )
    moved = moved.where(F.col("to_u") != F.col("to_v"))
    return step, moved.select(F.least("to_u", "to_v").alias("u"), F.greatest("to_u", "to_v").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (u, v); loops and null ends are ignored."""
    ends = F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v")
    left = stored(edges.where(F.col("u") != F.col("v")).select(*ends).distinct())
    steps: list[DataFrame] = []
    while left.count() > EDGES_PER_TASK:
        step, moved = _contracted(left, len(steps) % 2 == 0, len(steps))
        left = stored(moved.distinct())
        steps.append(step)
    last = left.coalesce(1).mapInArrow(_finish, "node bigint, to bigint")
    if not steps:
        return stored(last.select("node", F.col("to").alias("component")))
    steps.append(stored(last))
    found = steps[0].select("node", F.col("to").alias("root"))
    for step in steps[1:]:
        renamed = step.select(F.col("node").alias("root"), "to")
        found = found.join(renamed, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    found = stored(found)
    smallest = found.groupBy("root").agg(F.min("node").alias("component"))
    return stored(found.join(smallest, "root").select("node", "component"))
