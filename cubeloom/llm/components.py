"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from every node, as ``node, root``.

    ``edges`` has two long columns; their direction, repeats, nulls and loops do not matter,
    and nodes without an edge are not returned. Edges are rewired to ever smaller nodes in
    alternating steps (larger neighbours to the smallest neighbour, then smaller neighbours
    to the smallest one) until nothing changes and every component is a star. A step is a
    few joins and minimum aggregates with partial aggregation, so the centre of a large
    component is a skewed join key, which adaptive execution splits, and never a group
    gathered in one task. Each round ends in a reliable checkpoint; only a count and a
    checksum of the edges come to the driver.
    """
    a, b = (F.col(f"`{c}`").cast("long") for c in edges.columns[:2])
    links = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct()
    links = cut_lineage(links)
    before = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(now) == before or now[0] == 0:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
                links.select("lo", "lo").distinct())
        before = tuple(now)
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(links.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        links = cut_lineage(small.union(least.select("hi", "m")).distinct())
