"""Connected components of a table of links, by rounds of joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelane.session import materialize


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected(links: DataFrame) -> DataFrame:
    """Rows (node, root): for each node of a link (u, v) the smallest node it reaches.

    Large-star and small-star steps in turn until nothing changes: every round hangs
    nodes on smaller ones, and the number of links never grows. Each round is written to
    the shared folder, so no lineage piles up. Loops (u = v) are taken as nodes without
    links; repeated and reversed links do not matter; no links give no rows.
    """
    links = materialize(
        links.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    before, now = None, _state(links)
    while now != before:
        # Large star: larger neighbours of a node move to its smallest neighbour.
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "large-star")
        # Small star: smaller neighbours of a node, and the node, move to the smallest.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.select("u", F.col("m").alias("v"))
        links = materialize(moved.unionByName(own).distinct(), "small-star")
        before, now = now, _state(links)
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return nodes.unionByName(roots)
