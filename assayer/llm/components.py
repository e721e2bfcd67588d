"""Connected components by repeated contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the edges (a, b).

    Each round every node takes its smallest neighbour (or itself) as parent and edges move to the parents, so a
    component shrinks by half at least. Minima are aggregated before the shuffle and joins go by node, so that a node
    with very many edges does not meet in one task. Loops and repeated edges do no harm; no edges give no rows.
    """
    edges = stored(_plain(edges, "a", "b"), "edges")
    labels = None
    while True:
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        parents = stored(ends.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("parent")), "parents")
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("component"))
        else:
            above = parents.select(F.col("node").alias("component"), "parent")
            labels = stored(labels.join(above, "component", "left").select("node", F.coalesce("parent", "component").alias("component")), "labels")
        of_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        of_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = stored(_plain(edges.join(of_a, "a").join(of_b, "b"), "pa", "pb"), "edges")
        if edges.isEmpty():
            return labels


def _plain(edges: DataFrame, a: str, b: str) -> DataFrame:
    return edges.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
