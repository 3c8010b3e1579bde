"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import attach_groups, stored


def _nearest(both: DataFrame, total: int) -> DataFrame:
    """Each (u, v) with the smallest of u and all its neighbours, hot nodes split."""
    least = both.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("_n")
    )
    return attach_groups(both, least, ["u"], "_n", total)


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, root) for every node with a link; the root is the component's smallest node.

    Each round writes the links it leaves to the shared folder. Rounds go on until every
    link points to a root that has no other.
    """
    a, b = F.col(first), F.col(second)
    edges = stored(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "links",
    )
    # An upper bound of the rows of every round, as rounds never add links.
    total = 2 * edges.count()
    while total:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _nearest(both, total).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v")
        )
        large = stored(large, "large-star")
        small = _nearest(large, total)
        joined = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        edges = stored(joined.where("u != v").distinct(), "small-star")
        # Done when all nodes point to one node that points nowhere itself.
        pointing = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").select("u")
        doubled = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
        if not pointing.unionByName(doubled).take(1):
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
