"""Connected components by alternating stars (Kiveris and others, 2014), as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node and root (the component's smallest node) of every node with a link.

    ``links`` has two columns of one type. Each round is stored in the shared
    folder; a hub is handled by sums before the shuffle and split joins, its
    links are never gathered in one task. The number of rounds grows with the
    logarithm of the longest chain.
    """
    a, b = links.columns
    links = links.where(F.col(a) != F.col(b))
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links"
    )
    seen = _state(edges)
    while seen[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    joined = both.join(least, "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u").where("v != m")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()
