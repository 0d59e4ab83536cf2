"""Connected components of a graph of integers, by large stars and small stars.

Each round joins every node to the smallest one in its neighbourhood: first its larger
neighbours (large star), then its smaller ones (small star). Rounds end when the edges stop
changing. A node's smallest neighbour is a map-side ``min``, so a hub is never gathered in one
task, and each round's edges are written to the shared folder. Only a count and a sum of hashes reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.tables import write_shared


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Tie neighbours of each node u to the smallest node near u; ``edges`` are (u, v)."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    tied = edges.join(lowest, "u")
    if larger:
        return tied.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return tied.select("v", "low").union(tied.select("u", "low")).toDF("u", "v")


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("v", "u"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: for every node with an edge, the smallest node reachable.

    ``edges`` has two columns of integers. Loops, repeats and either direction are fine; no edges give no rows.
    """
    now = edges.toDF("u", "v").where("u != v").distinct()
    before = None
    while True:
        large = _star(_both(now), larger=True).where("u != v").distinct()
        # After a large star every edge points down: u is larger than v.
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = write_shared(_star(down, larger=False).where("u != v").distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select("v", "v").distinct()
            )
        before = state
