"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.sources.scratch import materialise


def _star(directed: DataFrame) -> DataFrame:
    """For every u, links its neighbours v to the smallest of u and all v."""
    least = directed.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    # a hub may be the neighbour of most vertices; next to a written table its rows can be split at run time
    return directed.join(materialise(least, "least"), "u")


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    return tuple(row.first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex with an edge; the component is its smallest vertex.

    ``edges`` has columns u and v. Rounds grow with the logarithm of the longest path. Only a row
    count and a checksum reach the driver.
    """
    current = materialise(
        edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    seen = _digest(current)
    while True:  # every round but the last changes the edges
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        # every edge now points down, so u's neighbours are all smaller
        small = _star(large)
        current = materialise(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .filter("u != v")
            .distinct()
        )
        now = _digest(current)
        if now == seen:
            break
        seen = now
    down = current.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("vertex")).distinct().withColumn("component", F.col("vertex"))
    return down.unionByName(roots)
