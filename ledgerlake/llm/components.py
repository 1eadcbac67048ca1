"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``.

    ``component`` is the smallest node reachable. Alternates large-star and
    small-star steps (Kiveris et al., "Connected Components in MapReduce and
    Beyond"): each replaces links by links to a smaller neighbour, until every
    node links to its component's smallest. The number of links never grows, and no
    task holds a node's neighbours: minima are combined in the tasks that read the
    links, and joined back. Where that join is a shuffle, the links of one large
    star meet in one partition, which adaptive execution cuts into several. Every
    step is stored.
    """
    edges = _clean(links.select("a", "b"))
    edges = stored(edges)
    seen = None
    while True:
        edges = stored(_small_star(_large_star(edges)))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    tops = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)


def _clean(edges: DataFrame) -> DataFrame:
    """Links from the larger to the smaller node, once each."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour to the smallest node next to it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    lowest = lowest.select("node", F.least("node", "m").alias("m"))
    # ``a`` is the larger end; each link hands it the smallest neighbour of ``b``.
    return _clean(
        edges.join(lowest, F.col("b") == F.col("node")).select(F.col("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each smaller neighbour, and the node itself, to the smallest of them."""
    lowest = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    joined = edges.join(lowest, F.col("a") == F.col("node"))
    return _clean(
        joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select(F.col("node").alias("a"), F.col("m").alias("b"))
        )
    )
