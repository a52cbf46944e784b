"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litwire.session import cut


def relabel(rows: DataFrame, comps: DataFrame, column: str) -> DataFrame:
    """``rows`` with ``<column>_comp``: the component of the node in ``column``, or the node itself."""
    named = comps.select(F.col("node").alias(column), F.col("comp").alias(f"{column}_comp"))
    joined = rows.join(named, column, "left")
    return joined.withColumn(f"{column}_comp", F.coalesce(f"{column}_comp", column))


def connect(edges: DataFrame, comps: DataFrame | None = None) -> DataFrame:
    """node, comp (the smallest node) after adding edges (a, b) to components known before.

    Each round hooks every node to its smallest neighbour, follows the hooks
    to their roots, and goes on with the edges between roots that are left.
    """
    if comps is None:
        # Made by the JVM: a table of Python rows, even of none, starts further Python workers on the executors.
        comps = edges.sparkSession.range(0).select(F.col("id").alias("node"), F.col("id").alias("comp"))
    graph = relabel(relabel(edges, comps, "a"), comps, "b").select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b"))
    graph = cut(graph.where("a <> b").distinct())
    while not graph.isEmpty():
        both = graph.union(graph.select("b", "a"))
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("comp"))
        hooks = cut(hooks)
        while True:
            ahead = relabel(hooks, hooks, "comp").select("node", "comp", "comp_comp")
            ahead = cut(ahead)
            hooks = ahead.select("node", F.col("comp_comp").alias("comp"))
            if ahead.where("comp <> comp_comp").isEmpty():
                break
        # Nodes named before move with their root; roots that are new join the table.
        moved = relabel(comps, hooks, "comp").select("node", F.col("comp_comp").alias("comp"))
        fresh = hooks.join(comps.select("node"), "node", "left_anti")
        comps = cut(moved.union(fresh))
        graph = relabel(relabel(graph, hooks, "a"), hooks, "b").select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b"))
        graph = cut(graph.where("a <> b").distinct())
    return comps
