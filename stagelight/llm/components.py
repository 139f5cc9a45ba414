"""Connected components of a graph too large for one machine: distributed union-find by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import stored


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` has columns a and b of one ordered type; the result has node and root, the least node it reaches.

    Nodes without an edge to another node are not in the result. Each round links every node's larger neighbours to
    its least neighbour, then its smaller neighbours, itself included, to the least one. Chains shorten by half or
    better, so rounds grow with the logarithm of the longest one; a node with very many neighbours only ever sends one
    minimum per task and receives one. Rounds end when no edge changes; each is written to the shared folder.
    """
    now = stored(_plain(edges), "edges")
    before = None
    for _ in range(max_rounds):
        now = stored(_small_star(_large_star(now)).withColumn("mark", F.xxhash64("a", "b")), "edges")
        state = now.agg(F.count("mark"), F.sum(F.col("mark").cast("decimal(38,0)"))).first()
        now = now.drop("mark")
        if state == before:
            nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
    raise RuntimeError(f"no end of star contraction after {max_rounds} rounds")


def _plain(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the least of the node and its neighbours."""
    least = edges.groupBy("a").agg(F.min("b").alias("least")).withColumnRenamed("a", "b")
    moved = edges.join(least, "b", "left")
    return _plain(moved.select("a", F.coalesce("least", "b").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of every node, and the node, to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a")
    return _plain(
        joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
    )
