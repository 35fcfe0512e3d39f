"""Connected components of a graph given as links, by alternating large and small stars.

Each round replaces links so that every node points to a smaller node of its component, and ends
when the links are stars (Kiveris et al., 2014). Nothing is gathered on the driver but two numbers a
round, and each round is cut off by a checkpoint in the shared folder. A node's smallest neighbour
is an aggregate, so a node with very many links is not collected anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Takes and returns links with a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    return joined.select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*").where("a > b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (two columns of one orderable type); root is the component's smallest node.

    Links from a node to itself and links with a null end are ignored; no links give no rows.
    """
    links = links.toDF("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, seen = checkpoint(links), None
    while True:
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen or now[0] == 0:
            break
        seen = now
        links = checkpoint(_small_star(_large_star(links)))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b").distinct())
