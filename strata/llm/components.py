"""Connected components by alternating large-star and small-star steps.

Each step is a pre-aggregated minimum per node and a join back, written to
the shared scratch folder; no neighbour list is ever gathered, so the centre
of a large star costs one row per edge and no more. The minima are read back
from files, so a hot node is a skewed join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import staged


def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or the node)."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("lo"), F.least("u", "m").alias("m"))
    moved = edges.join(staged(least, "cc-min", 2 * n), "lo").select("hi", F.col("m").alias("lo"))
    return staged(moved.distinct(), "cc-large", n)


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = staged(edges.groupBy("hi").agg(F.min("lo").alias("m")), "cc-min", n)
    moved = edges.join(least, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return staged(moved.unionAll(least.select("hi", F.col("m").alias("lo"))).distinct(), "cc-small", n)


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long) -> one row (node, root) per linked node.

    ``root`` is the smallest node that can be reached. Null ends, self links
    and repeated links are ignored; an empty input gives an empty result.
    """
    links = staged(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")), "cc-links")
    edges = staged(links.distinct(), "cc-edges", links.count())
    state = _checksum(edges)
    while state[0]:
        edges = _small_star(_large_star(edges, state[0]), state[0])
        before, state = state, _checksum(edges)
        if before == state:
            break
    nodes = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes.unionAll(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
