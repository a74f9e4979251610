"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapstats.llm.common import broadcast_or_shuffled
from lapstats.session import materialize


def _sum(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (the smallest reachable node) for every node that has a link.

    Alternates two star operations until the links no longer change: larger
    neighbours, then smaller ones, are hung on the smallest neighbour. Each step
    is a partial minimum per node and a join back on the node, so a node with
    very many links is combined before the shuffle and split as a skewed join;
    no neighbourhood is gathered in one task. The minima are broadcast only while
    the count of links bounds them. The number of rounds grows with the logarithm
    of the longest path. Each step is written, which cuts lineage.
    """
    edges = materialize(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                        .filter("a <> b").distinct(), "links")
    before = _sum(edges)
    while before[0]:
        most = 2 * before[0]  # nodes, and links after the first step
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = materialize(both.join(broadcast_or_shuffled(least, most), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .filter("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(broadcast_or_shuffled(least, most), "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        after = _sum(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
