"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatlens.llm.staging import stage


def flatten(parents: DataFrame) -> DataFrame:
    """(node, parent) -> the same with the end of each chain as parent; each round doubles the distance spanned."""
    while True:
        above = parents.select(F.col("node").alias("_node"), F.col("parent").alias("_above"))
        further = parents.join(above, parents["parent"] == above["_node"], "left")
        new = F.coalesce("_above", "parent")
        moved = stage(further.select("node", new.alias("parent"), (new != F.col("parent")).alias("moved")))
        parents = moved.select("node", "parent")
        if moved.where("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> (node, root) for every node with a link; the root is the smallest node reachable.

    A round points every node to its smallest neighbour, flattens the pointers and replaces nodes
    by their roots, so at least half of the nodes still linked disappear. Minima are summed up
    before the shuffle, and every join reads two written tables, so a hub with a third of all links
    is never gathered in one task. Nulls and loops are ignored; repeated links count once.
    """
    found: DataFrame | None = None
    edges = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    while True:
        both = edges.select(F.col("b").alias("node"), F.col("a").alias("other")).unionAll(
            edges.select(F.col("a").alias("node"), F.col("a").alias("other"))
        )
        roots = flatten(stage(both.groupBy("node").agg(F.min("other").alias("parent"))))
        if found is None:
            found = roots
        else:
            later = roots.select(F.col("node").alias("_node"), F.col("parent").alias("_root"))
            merged = found.join(later, found["parent"] == later["_node"], "left")
            found = stage(merged.select("node", F.coalesce("_root", "parent").alias("parent")))
        of_a = roots.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        of_b = roots.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        half = stage(edges.join(of_b, "b").where("a <> rb").select("a", F.col("rb").alias("b")).distinct())
        left = half.join(of_a, "a").where("ra <> b")
        edges = stage(left.select(F.least("ra", "b").alias("a"), F.greatest("ra", "b").alias("b")).distinct())
        if edges.isEmpty():
            return found.select("node", F.col("parent").alias("root"))
