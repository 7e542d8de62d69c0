"""Connected components by alternating large and small stars (Kiveris et al., 2014).

Every round works on the edge table alone, in two aggregations and joins, and is written to the shared
folder; nodes and components never come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytally.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of the links (a, b): the smallest node that it reaches.

    Links of a node with itself, in both directions and repeated are allowed; no links give no rows.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "graph",
    )
    before = None
    while True:
        # As sums, so that a round without a change is seen without comparing tables.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.toDF("node", "component").union(edges.select("b", "b").distinct())
        before = now
        # Large star: all greater neighbours of a node go to its smallest neighbour.
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct(), "graph")
        # Small star: a node and its smaller neighbours go to the smallest of these.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        edges = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.toDF("a", "b"))
        edges = stored(edges.filter("a <> b").distinct(), "graph")
