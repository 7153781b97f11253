"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkatlas.runtime import stored


def star_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the smallest node reached.

    Rounds of large and small stars: every node hands its smallest neighbour
    to its larger neighbours, then to its smaller ones.  A round is two partial
    aggregations and two joins on node; the number of rounds grows with the
    logarithm of the longest chain, and the table never grows beyond its links.
    Nodes are of any type that can be ordered.  Loops and nulls are left out.
    """
    pairs = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Larger neighbours of u now point to the smallest node around u.
        large = stored(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(moved.unionByName(least.withColumnRenamed("m", "v")).distinct())
        same = F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        if pairs.agg(*same).first() == after.agg(*same).first():
            # Now every node has exactly one link, to its root.
            roots = after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        pairs = after
