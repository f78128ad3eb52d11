"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.llm.stages import staged, unstage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One half step: link the larger (or the smaller) neighbours of each node to its least neighbour."""
    if large:
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    linked = around.join(least, "a")
    if large:
        linked = linked.filter(F.col("b") > F.col("a"))
        return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
    own = least.select("a", F.col("m").alias("b"))
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own).filter("a != b").distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """The least node reachable from each node that has an edge: ``node, component``.

    ``edges`` has two long columns ``a`` and ``b``; edges from a node to itself and repeated
    edges don't matter. Nodes without an edge are left to the caller. Alternating large
    and small stars shorten every path to its least node in a logarithmic number of rounds.
    A node with very many neighbours is met by partial minima and a join that Spark can
    split; no list of neighbours is ever formed. Each round is a written table, and the
    one before it is removed. Should ``max_rounds`` not do, an error is raised.
    """
    current = staged(edges.select("a", "b").filter("a != b").distinct(), "edges")
    for _ in range(max_rounds):
        after = staged(_stars(_stars(current, large=True), large=False), "edges")
        sums = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))]
        old = current.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).agg(*sums).first()
        new = after.agg(*sums).first()
        unstage(current)
        current = after
        if old == new:
            nodes = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
            return nodes.unionByName(nodes.select(F.col("component").alias("node"), "component").distinct())
    raise RuntimeError("the components did not settle")
