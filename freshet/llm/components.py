"""Connected components of a link table by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import materialized


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    lower = edges.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return lower.unionByName(least.select("u", F.col("least").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the component's least node.

    Each round is joins and minima that combine before their shuffle, written to the
    shared folder; the number of rounds grows with the logarithm of the longest chain.
    The driver sees one checksum a round. Self-links and repeated links change nothing.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialized(edges.distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
        edges = materialized(_small_star(_large_star(edges).distinct()).distinct(), "links")
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
