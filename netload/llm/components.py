"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netload.llm.schema import kept


def _nearest(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the smallest of u and its neighbours as ``low``.

    An aggregate and a join rather than a window: the aggregate combines before
    the shuffle and adaptive execution can split the join, so a node with very
    many neighbours is no group in one task.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return edges.join(low, "u")


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: root is the smallest node of its component, for every node on an edge.

    ``edges`` has columns u and v of one orderable type. Alternates the
    large-star and small-star steps (Kiveris et al., 2014), which need about
    log(n) rounds whatever the length of a chain. Every round is written to the
    scratch folder. No nulls; loops and repeated edges do no harm.
    """
    edges = kept(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _summary(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _nearest(both).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.filter("u <> v").distinct()
        near = _nearest(large)  # every edge of large goes from the greater to the smaller node
        small = near.select(F.col("v").alias("u"), F.col("low").alias("v")).union(near.select("u", F.col("low").alias("v")))
        edges = kept(small.filter("u <> v").distinct(), "edges")
        now = _summary(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
