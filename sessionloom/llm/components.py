"""Connected components of a links table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import written_once


def components(links: DataFrame) -> DataFrame:
    """One row per linked node: node, root (the smallest node reachable). ``links``: columns a, b of one type.

    Rounds of large and small stars. A node's neighbours are never gathered: its smallest neighbour is an
    aggregate, joined back to the links, so hubs are combined before the shuffle and split as skewed joins.
    """
    edges = written_once(links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour moves to the smallest one
        large = written_once(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                             .distinct())
        # small star: a node's smaller neighbours move to the smallest of them
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.*").filter("u <> v").distinct()
        new = written_once(small)
        # a star forest: nobody points to a node that points elsewhere, and nobody points twice
        settled = not (new.join(new.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
                       or new.groupBy("u").count().filter("count > 1").limit(1).count())
        edges = new
        if settled:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return written_once(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots))
