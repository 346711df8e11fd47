"""Connected groups of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from augury.sources.shared import removed, written


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of each node of links (a, b), root the least node it is connected with.

    Each round takes the least parent of a node's neighbours for it and for its own parent, and then the parent's parent:
    the number of rounds grows with the logarithm of the longest path. All steps are joins and partial minima.
    """
    both = written(links.where("a <> b").select("a", "b").unionByName(links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    parents = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("p")).select(F.col("a").alias("node"), "p"), "parents")
    while True:
        up = parents.select(F.col("node").alias("p"), F.col("p").alias("g"))
        grand = written(parents.join(up, "p").select("node", "p", "g"), "grand")
        near = both.join(grand.select(F.col("node").alias("b"), F.col("g").alias("m")), "b").groupBy("a").agg(F.min("m").alias("m"))
        found = grand.join(near, F.col("node") == F.col("a")).select("node", "p", F.least("g", "m").alias("m"))
        offers = found.select("node", "m").unionByName(found.select(F.col("p").alias("node"), "m"))
        now = written(offers.groupBy("node").agg(F.min("m").alias("p")), "parents")
        moved = now.join(parents.withColumnRenamed("p", "old"), "node").where("p <> old").isEmpty()
        removed(parents, grand)
        parents = now
        if moved:
            removed(both)
            return parents.select("node", F.col("p").alias("root"))
