"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.workspace import keep


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u long, v long); root is the smallest node that its edges reach.

    Null ends and loops are ignored; without edges there are no rows. Each round joins the edges
    with the smallest neighbour of each node, found with map-side minima, and is written to the
    shared folder; the number of rounds grows with the logarithm of the size of a component. Two
    numbers a round come to the driver.
    """
    ends = edges.where("u is not null and v is not null and u <> v")
    links = keep(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _content(links)
    while seen[0]:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_smallest(both, F.least(F.min("v"), F.col("u"))).where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _with_smallest(large, F.min("v"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        links = keep(small.where("u <> v").distinct())
        now = _content(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(links.select(F.col("u").alias("node"), F.col("v").alias("root")))


def _with_smallest(edges: DataFrame, smallest) -> DataFrame:
    """Joined by the node and its hash: both sides are then dealt out for the join, and a hot node can be split."""
    found = edges.groupBy("u").agg(smallest.alias("m")).withColumn("h", F.xxhash64("u"))
    return edges.withColumn("h", F.xxhash64("u")).join(found, ["u", "h"])


def _content(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
