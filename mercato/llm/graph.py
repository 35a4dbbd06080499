"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.store import keep


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node it
    reaches.

    Each round links every node's larger neighbours to its smallest one, then
    the smaller ones likewise, until nothing changes (about log2 of the
    longest path rounds).  A round is two aggregates and joins on the node,
    never a group collected in one place; only its row count and checksum
    reach the driver.  Rounds are written to the shared folder.
    """
    now = keep(edges.select(F.col(u).alias("u"), F.col(v).alias("v"))
               .where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # every edge now runs from a larger node u to a smaller one v
        down = large.where("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        now = keep(small.where("u <> v").distinct(), "edges")
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
