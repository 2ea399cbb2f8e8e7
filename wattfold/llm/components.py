"""Connected components of link tables by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattfold.llm import texts as T


def _least(pairs: DataFrame) -> DataFrame:
    """(a, least b) of each a; combined in each task before the shuffle."""
    return T.checkpointed(pairs.groupBy("a").agg(F.min("b").alias("m")))


def _two(first: tuple[str, str], second: tuple[str, str]):
    """Two pairs (a, b) from each row, made in one pass over it."""
    return F.inline(F.array(*(F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in (first, second))))


def _stars(pairs: DataFrame) -> bool:
    """No node is both above one node and below another, and each has one centre; one shuffle."""
    ends = pairs.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    odd = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1 and up > 0")
    return odd.agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node of the links (a, b), nulls and loops aside.

    Large-star and small-star steps in turn: each joins a node's neighbours to the smallest node among them. Every step's
    table is written to the shared checkpoint folder. The smallest neighbours are a table of their own, so a node with very
    many links is a skewed join side that adaptive execution splits, never a gathered group. Ends when links are stars.
    """
    pairs = T.checkpointed(
        links.where("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).select("a", "b").distinct()
    )
    while True:
        # Large star: every larger neighbour is linked to the smallest one around.
        both = pairs.select(_two(("a", "b"), ("b", "a")))
        least = _least(both)
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        large = T.checkpointed(large)
        # Small star: smaller neighbours and the node itself are linked to the smallest one.
        small = large.join(_least(large), "a").select(_two(("a", "m"), ("b", "m"))).where("a <> b").distinct()
        small = T.checkpointed(small)
        if _stars(small):
            return small.select(F.col("a").alias("node"), F.col("b").alias("component")).union(small.select("b", "b").distinct())
        pairs = small
