"""Connected components by hooking and pointer jumping, each step a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.sizing import store


def _roots(parents: DataFrame) -> DataFrame:
    """(node, root) from (node, parent) where a parent is smaller than its node."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        # Distinct tables on both sides, so that a parent of very many nodes is split.
        jumped = store(
            parents.join(up, "parent", "left").select(
                "node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")
            )
        )
        parents = jumped.select("node", "parent")
        if jumped.where("moved").isEmpty():
            return parents.withColumnRenamed("parent", "root")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of (a, b) that are not the smallest of their component.

    Every round hooks each larger end onto its smallest neighbour below and then
    follows parents to the top, so rounds grow with the logarithm of the size.
    """
    found = None
    while True:
        hooks = (
            edges.where("a != b")
            .groupBy(F.greatest("a", "b").alias("node"))
            .agg(F.min(F.least("a", "b")).alias("parent"))
        )
        roots = _roots(store(hooks))
        if found is None:
            found = roots
        else:
            above = roots.select(F.col("node").alias("root"), F.col("root").alias("top"))
            moved = found.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
            found = store(moved.unionByName(roots))
        edges = store(relabel(relabel(edges, "a", roots), "b", roots).where("a != b").distinct())
        if edges.isEmpty():
            return found


def relabel(df: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """``df`` with the nodes in ``column`` replaced by their roots."""
    named = roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return df.join(named, column, "left").withColumn(column, F.coalesce("_root", column)).drop("_root")
