"""Connected components of an edge table, by alternating large-star and small-star steps.

Edges point from a larger to a smaller node. A large-star step ties a node's larger neighbours to the smallest node of its
neighbourhood, a small-star step its smaller neighbours and itself; repeated edges fall together after each, so a dense group
soon is one star around its smallest node. The number of rounds grows with the logarithm of a component's size.

Only two numbers per round reach the driver. Smallest neighbours combine before each shuffle, and joins read tables written to
the shared folder: that cuts the lineage and leaves an exchange on either side, so AQE splits the partition of a node with
very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parceltrail.llm.common import stored


def _pointed(edges: DataFrame) -> DataFrame:
    """Distinct edges (a, b) with a > b, without loops."""
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.distinct()


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and a sum of their hashes: equal for equal tables."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a, b: any orderable type): the smallest node that it reaches."""
    edges = stored(_pointed(edges), "edges")
    before = None
    while (now := _mark(edges)) != before:
        before = now
        # Large star: (a, b) with a > b becomes (a, smallest of b's neighbourhood).
        near = edges.groupBy(F.col("b").alias("of")).agg(F.min("b").alias("low"))
        below = edges.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("low"))
        low = stored(near.unionByName(below).groupBy("of").agg(F.min("low").alias("low")), "low")
        large = edges.join(low, F.col("b") == F.col("of")).select("a", F.col("low").alias("b"))
        large = stored(_pointed(large), "large")
        # Small star: a node and its smaller neighbours go to the smallest of these.
        least = stored(large.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("low")), "least")
        small = large.join(least, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = stored(_pointed(small.unionByName(least.select(F.col("of").alias("a"), F.col("low").alias("b")))), "small")
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    heads = edges.select(F.col("b").alias("node")).distinct()
    return labels.unionByName(heads.select("node", F.col("node").alias("label")))
