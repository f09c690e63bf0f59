"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fieldops.llm.common import staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges`` (two long columns): root is the
    smallest node of its component.

    Each round joins every node to the smallest of its neighbourhood (minima
    are partial aggregates, so hubs are combined map-side; the join back may be
    split by Spark where skewed) and stages the edges in the shared folder.
    The number of rounds follows the logarithm of the longest path.  Nothing
    but two sums per round reaches the driver.  Null ends and loops drop out;
    an empty table gives an empty result."""
    def kept(e: DataFrame) -> tuple[DataFrame, tuple]:
        """The edges, staged, with their number and a sum over them taken on the way."""
        seen = Observation()
        out = staged(e.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "cc")
        return out, (seen.get["n"], seen.get["h"])

    now, last = kept(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                     .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    while last[0]:
        # Large star: every larger neighbour goes to the smallest of the neighbourhood and the node.
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("lo")).select("u", F.least("u", "lo").alias("lo"))
        wide = (both.join(least, "u").where(F.col("v") > F.col("u"))
                .select(F.col("v").alias("u"), F.col("lo").alias("v")).where("u <> v").distinct())
        # Small star: the smaller neighbours and the node go to the smallest.
        low = wide.groupBy("u").agg(F.min("v").alias("lo"))
        small = (wide.join(low, "u").select(F.col("v").alias("u"), F.col("lo").alias("v"))
                 .unionByName(low.select("u", F.col("lo").alias("v"))).where("u <> v").distinct())
        now, mine = kept(small)
        if mine == last:
            break
        last = mine
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
