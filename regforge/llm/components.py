"""Connected components of an undirected graph of long ids, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regforge.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); one root per component.

    Each round hooks a node to its neighbour of lowest random rank, follows the parents
    once, and contracts the edges; ranks change with the round, so long chains shrink by a
    constant factor as well. A hub leaves each task as one row, since the lowest rank is a
    combinable aggregate. Runs jobs; the number of rounds is logarithmic in the longest path.
    """
    edges = staged(edges.select("a", "b").filter("a <> b"), "edges")
    members = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node"))
    turn = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("rank"), F.col(c).alias("id"))  # noqa: B023, E731
        # The node itself is among its neighbours, so the lowest rank is a combinable minimum.
        near = both.select("a", rank("b").alias("r")).union(edges.select("a", rank("a"))).union(edges.select("b", rank("b")))
        hooked = staged(near.groupBy(F.col("a").alias("id")).agg(F.min("r").getField("id").alias("parent")), "hooked")
        up = hooked.select(F.col("id").alias("parent"), F.col("parent").alias("above"))
        parents = staged(hooked.join(up, "parent").select("id", F.col("above").alias("parent")), "parents")
        for end in ("a", "b"):
            edges = edges.join(parents.withColumnRenamed("id", end), end).drop(end).withColumnRenamed("parent", end)
        edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
        moved = members.join(parents.withColumnRenamed("id", "root"), "root", "left")
        members = staged(moved.select("node", F.coalesce("parent", "root").alias("root")), "members")
        turn += 1
    return members
