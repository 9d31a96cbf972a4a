"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hopweave.llm.common import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node in an edge: the smallest node of its component.

    ``edges``: a written table, or a union of such ones; repeated links are allowed.

    Every step sends a node's larger (or smaller) neighbours to its smallest neighbour and
    keeps one row per link, so a hub's links are joined, never gathered; rounds grow with
    the logarithm of the component size.  Each round is written to the shared folder; its
    row count and content sum, taken while it is written, tell when nothing changes any more.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    before = None
    while True:
        # large star: larger neighbours of a node go to its smallest neighbour (or itself)
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small star: smaller neighbours of a node, and the node, go to its smallest neighbour
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        links = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        seen = Observation()
        links = stage(links.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("content")), "links")
        now = seen.get
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
