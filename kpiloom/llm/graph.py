"""Connected components of an undirected graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import storage


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, of every node of ``edges`` (a, b).

    Alternating star contraction: each node first hands its larger neighbours, then its smaller
    ones, to the smallest node it knows, until every component is a star around its smallest node.
    Rounds grow with the logarithm of the longest path. Each round is written, so lineage stays
    short; a hub's edges are joined to one row for the hub, which Spark may split. Edges with a null
    end and loops are left out.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).dropna()
    stars = storage.written(pairs.filter("u != v").distinct(), "stars")
    before = None
    while True:
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        handed = large.join(smallest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = storage.written(handed.unionByName(smallest.withColumnRenamed("m", "v")).distinct(), "stars")
    nodes = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.unionByName(stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
