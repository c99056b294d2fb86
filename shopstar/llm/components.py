"""Connected components of a link table as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.llm.common import written


def _targets(ends: DataFrame) -> DataFrame:
    """(u, m, d): for each node its target m, the smallest of u and its
    neighbours, and their number d. Summed up front and written, so a join
    with it is between two plain tables: small ones broadcast by size, hot u
    split by AQE."""
    return written(ends.groupBy("u").agg(
        F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("d")), "star_targets")


def _is_stars(targets: DataFrame) -> bool:
    """Whether the links of ``targets`` (both ways) are stars around their
    smallest nodes. Of n nodes, r are their own target, and each other one
    has a smaller neighbour. With as many links as other nodes each has just
    one; if the r nodes hold all links, that one is a star's centre."""
    own = F.col("m") == F.col("u")
    zero = F.lit(0)
    nodes, centres, held, ends = targets.agg(
        F.count("*"), F.count_if(own), F.coalesce(F.sum(F.when(own, F.col("d"))), zero),
        F.coalesce(F.sum("d"), zero)).first()
    return 2 * (nodes - centres) == ends == 2 * held


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``: root is the component's
    smallest node. Alternating large-star and small-star rounds (Kiveris et
    al., 2014), each written to the shared folder, until the links are stars.
    Rows with a null end and self links are no links; an empty table
    gives an empty result."""
    def ordered(df: DataFrame, u: str, v: str) -> DataFrame:
        return (df.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b"))
                .where("a <> b").distinct())

    clean = links.select(F.col(a).alias("x"), F.col(b).alias("y")).dropna()
    edges = written(ordered(clean, "x", "y"), "links")
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        targets = _targets(both)
        if _is_stars(targets):
            break
        large = both.where("v > u").join(targets, "u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        large = written(ordered(large, "x", "y"), "large_star")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = down.join(_targets(down), "u")
        edges = written(ordered(
            small.select(F.explode(F.array("u", "v")).alias("x"), F.col("m").alias("y")),
            "x", "y"), "small_star")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
