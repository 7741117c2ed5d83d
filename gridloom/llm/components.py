"""Connected components of a table of links, by contraction.

In every round each node joins its neighbour of smallest hash, links are drawn
between the joined nodes, and links inside one are dropped. Hashes order the nodes
at random, so a constant share of them goes in each round whatever the shape; a
node with very many links only adds partial minima.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.plans.joins import settle


def _rank(c: Column) -> Column:
    return F.struct(F.xxhash64(c).alias("h"), c.alias("node"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``) for every node that has a link to another node.

    All nodes of a component have the same root, one of them. Links may repeat,
    point either way or to the same node; a null end is no link. Without links
    the result is empty.
    """
    left, right = F.col(a), F.col(b)
    edges = settle(links.where(left != right).select(left.alias("a"), right.alias("b")).distinct())
    found: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(_rank(F.col("b"))).alias("m"))
        step = settle(
            least.select(
                F.col("a").alias("node"),
                F.least(_rank(F.col("a")), F.col("m"))["node"].alias("root"),
            )
        )
        up = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        over = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(up, "a").join(over, "b").where(F.col("ra") != F.col("rb"))
        edges = settle(
            moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )
        if found is None:
            found = step
        else:
            after = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = settle(
                found.join(after, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            )
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found
