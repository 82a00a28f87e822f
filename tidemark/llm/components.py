"""Connected components of a graph held as a frame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import discard, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: each node that has an edge, and the smallest node it is joined to.

    Alternates two steps that keep components and draw edges to small nodes (Kiveris et al., 2014): the
    large step joins each node's larger neighbours to its least neighbour, the small step its smaller ones.
    Each is a minimum per node, combined before the shuffle, and a join; a node with very many edges is
    split by the skew join. Rounds are written to the shared folder. It ends when all edges point to a root,
    after about as many rounds as the logarithm of the longest path.
    """
    links = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()
    links = materialize(links, "links")
    while True:
        both = links.toDF("u", "v").union(links.select("hi", "lo").toDF("u", "v"))
        least = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("w"), F.least("u", "v").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select("m", "v").where("m < v").toDF("lo", "hi")
        low = large.groupBy("hi").agg(F.min("lo").alias("m")).toDF("top", "m")
        joined = large.join(low, F.col("hi") == F.col("top")).select("m", "lo", "hi")
        small = joined.where("m < lo").select("m", "lo").toDF("lo", "hi").union(joined.select("m", "hi").toDF("lo", "hi"))
        before, links = links, materialize(small.distinct(), "links")
        discard(before)
        # A root is no node's larger end, and each node has one edge: then the edges are stars.
        tails = links.groupBy("hi").agg(F.count("*").alias("n")).toDF("tail", "n")
        if tails.where("n > 1").isEmpty() and links.join(tails, F.col("lo") == F.col("tail"), "left_semi").isEmpty():
            break
    roots = links.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    return roots.union(links.select("hi", "lo"))
