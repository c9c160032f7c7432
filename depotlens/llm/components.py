"""Connected components of a graph of links between rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotlens.session import materialize


def connected_components(links: DataFrame, left: str = "a", right: str = "b", steps: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over the links, for every node that has one.

    Alternating star contraction: every node hands its smallest neighbour to its larger neighbours, then to
    all its smaller ones, until each component is a star around its smallest node. Star sizes are only
    counted and minimised, never collected, and rows of a hot centre are aggregated before the shuffle.
    Each step's links are written, so lost executors cost one step.
    """
    links = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b").distinct()
    links = materialize(links, "links")
    for _ in range(steps):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        after = materialize(small.distinct(), "links")
        links = after
        # A star forest: no node has two centres, and no centre hangs from another one.
        ends = F.inline(F.array(F.struct(F.col("a").alias("n"), F.lit(1).alias("c")), F.struct(F.col("b").alias("n"), F.lit(0).alias("c"))))
        nodes = after.select(ends).groupBy("n").agg(F.sum("c").alias("up"), F.min("c").alias("down"))
        if nodes.where("up > 1 or (up = 1 and down = 0)").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {steps} steps")
    roots = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
