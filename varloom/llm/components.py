"""Connected components of a table of links, by large-star and small-star rounds over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import discard, durable


def _least(edges: DataFrame) -> DataFrame:
    """edges (u, v) with the least of u and all its v as m."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "u")


def components(links: DataFrame) -> DataFrame:
    """From links (a, b) of longs: a durable table (id, component) of every linked id; component is its least id.

    Each round writes its edges, so that a lost executor costs one round. A hub's edges are dealt anew by adaptive
    execution, since the least neighbour comes from a partial aggregate and then joins back."""
    edges = durable(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        near = _least(large)
        small = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        last, edges = edges, durable(small, "edges")
        discard(last)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
