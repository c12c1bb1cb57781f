"""Connected components of an edge table, by hooking, pointer jumping and contraction in DataFrame joins.

Each round every node hooks onto its smallest neighbour if that is smaller, the trees so made are jumped to their roots,
and edges are drawn anew between roots, without loops and repeats. All nodes of a tree leave but one, and every
component that has an edge left loses at least half of its nodes, so the rounds are few and their tables shrink. Rounds are
written to the shared folder, so a lost executor costs one step, and deleted when the next has been written. Hot nodes
meet in aggregates with map-side combining, and joins read stored tables, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def _ordered(a: str, b: str, edges: DataFrame) -> DataFrame:
    """Distinct edges, smaller node first, without loops."""
    return edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Stored (node, component) of every node of a table of edges (a, b) between different nodes; component: the smallest node."""
    spark = edges.sparkSession
    scratch = C.Scratch(spark)
    edge = scratch.cut(_ordered("a", "b", edges), "edges")
    labels = None
    while not edge.isEmpty():
        both = edge.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edge.select(F.col("b").alias("node"), F.col("a").alias("other")))
        up = scratch.cut(both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("up")), "up")
        while True:
            further = up.select(F.col("node").alias("up"), F.col("up").alias("further"))
            jumped = scratch.cut(up.join(further, "up").select("node", F.col("further").alias("up"), (F.col("further") < F.col("up")).alias("moved")), "up")
            done = jumped.where("moved").isEmpty()
            scratch.drop(edge, labels, jumped)
            up = jumped
            if done:
                break
        if labels is None:
            fresh = up.select("node", F.col("up").alias("component"))
        else:
            fresh = labels.join(up.select(F.col("node").alias("component"), "up"), "component", "left").select("node", F.coalesce("up", "component").alias("component"))
        fresh = scratch.cut(fresh, "labels")
        near = edge.join(up.select(F.col("node").alias("a"), F.col("up").alias("up_a")), "a").join(up.select(F.col("node").alias("b"), F.col("up").alias("up_b")), "b")
        edge = scratch.cut(_ordered("up_a", "up_b", near), "edges")
        scratch.drop(edge, fresh)
        labels = fresh
    if labels is None:
        return spark.createDataFrame([], "node long, component long")
    scratch.drop(labels)
    return labels
