"""Connected components of edge tables by alternating star contraction."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stratavox.operators import groups
from stratavox.session import checkpointed


def merged(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least node that each of ``n`` nodes can reach over the edges (a, b)."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: neighbours above a node move to its least neighbour; small star: the node and those below it do."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = both.join(least, "a")
    if large:
        out = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node it can reach; nodes without edges are not listed.

    Each round writes its edges to the shared checkpoint folder, so lost executors cost one round at most. The rounds end
    when the edges no longer change; their number grows with the logarithm of the largest component.
    """
    now = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct())
    digest = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    seen = digest(now)
    for _ in range(most_rounds if seen[0] else 0):
        now = checkpointed(_stars(_stars(now, True), False))
        new = digest(now)
        if new == seen:
            break
        seen = new
    else:
        if seen[0]:
            raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def grouped(edges: DataFrame, *keys: str) -> DataFrame:
    """``edges`` (a, b, keys and others) with root, which the edges of a component share; it need not be the component's least node.

    A task joins the edges of a group of ``keys``; only nodes that several groups hold reach the graph, as edges between the
    groups' components.
    """
    def run(table: pa.Table) -> pa.Table:
        a, b = (table[c].to_numpy() for c in ("a", "b"))
        node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = merged(len(node), at[: len(a)], at[len(a) :])
        return table.append_column("root", pa.array(node[root[at[: len(a)]]]))

    schema = StructType([*edges.schema.fields, StructField("root", LongType())])
    local = checkpointed(groups.spread(edges, *keys).groupBy(*keys).applyInArrow(run, schema))
    held = local.select(F.col("a").alias("n"), "root").unionByName(local.select(F.col("b").alias("n"), "root"))
    held = held.groupBy("n").agg(F.collect_set("root").alias("roots")).where(F.size("roots") > 1)
    found = components(held.select(F.array_min("roots").alias("a"), F.explode("roots").alias("b")).distinct())
    found = found.select(F.col("node").alias("root"), F.col("root").alias("__root"))
    return local.join(found, "root", "left").withColumn("root", F.coalesce("__root", "root")).drop("__root")


def label(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """``nodes`` with the root of each; a node without edges is its own."""
    found = components(edges).select(F.col("node").alias("__node"), "root")
    return nodes.join(found, F.col(node) == F.col("__node"), "left").withColumn("root", F.coalesce("root", F.col(node))).drop("__node")
