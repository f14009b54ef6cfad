"""Connected components of a link table: distributed union-find in joins and aggregates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dnsight.sources.storage import scratch, stage

#: Links of whole-number nodes that one task follows to the end.
LOCAL = 1 << 20


def _followed(batches):
    """Node and root, of all nodes that are none; of links between whole numbers."""
    links = [np.column_stack([batch.column(c).to_numpy() for c in ("u", "v")]) for batch in batches if batch.num_rows]
    if not links:
        return
    nodes, index = np.unique(np.concatenate(links), return_inverse=True)
    u, v = index.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while len(u):
        low, high = np.minimum(root[u], root[v]), np.maximum(root[u], root[v])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[u] != root[v]
        u, v = u[apart], v[apart]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[root[moved]])], ["u", "p"])


def _compressed(parents: DataFrame) -> DataFrame:
    """Parents (u, p) doubled until every p is a root, that is no u."""
    while True:
        above = parents.select(F.col("u").alias("p"), F.col("p").alias("q"))
        doubled = stage(
            parents.join(above, "p", "left")
            .select("u", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved"))
        )
        parents = doubled.select("u", "p")
        if doubled.filter("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node that `links` (a, b) names.

    Each round hooks every node with a smaller neighbour to its smallest one and follows the hooks down
    to nodes without one, which take the place of all others in the links. A node is hooked in one
    round only, so the hooks of all rounds are a forest, which is followed once more at the end. Tables
    of a round are written to the shared folder, the result beyond the call. Null ends and loops are ignored.
    A node with very many links is one key of a join, which adaptive execution splits. Up to LOCAL links that
    are left, between whole numbers, are followed by one task.
    """
    with scratch(links.sparkSession) as keep:
        return keep(_components(links))


def _components(links: DataFrame) -> DataFrame:
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("a is not null and b is not null and u <> v").distinct()
    )
    nodes = edges.select("v").union(edges.select("u")).distinct().withColumnRenamed("v", "node")
    forest, rounds = None, 0
    whole = dict(edges.dtypes)["u"] == "bigint"
    while left := edges.count():
        if whole and left <= LOCAL:
            hooks = stage(edges.select("u", "v").coalesce(1).mapInArrow(_followed, "u long, p long"))
            forest, rounds = hooks if forest is None else forest.unionByName(hooks), rounds + 1
            break
        hooks = _compressed(edges.groupBy("u").agg(F.min("v").alias("p")))
        forest, rounds = hooks if forest is None else forest.unionByName(hooks), rounds + 1
        low = hooks.select(F.col("u").alias("v"), F.col("p").alias("q"))
        # Every u is hooked; a v may be.
        edges = stage(
            edges.join(hooks, "u").join(low, "v", "left")
            .select(F.col("p").alias("a"), F.coalesce("q", "v").alias("b")).filter("a <> b")
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
        )
    if forest is None:
        return nodes.withColumn("root", F.col("node"))
    if rounds > 1:
        forest = _compressed(forest)
    return nodes.join(forest.withColumnRenamed("u", "node"), "node", "left").select(
        "node", F.coalesce("p", "node").alias("root")
    )
