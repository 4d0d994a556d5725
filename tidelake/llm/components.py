"""Connected components of a graph of links, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidelake.session import staged


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbours and itself."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    moved = down.join(least, "a").filter("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.union(least.select("a", F.col("root").alias("b")))


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` of every node in ``links(a, b)``; the root is the smallest node reachable.

    Large-star and small-star rounds (Kiveris et al., 2014): each is one grouping and one join
    on a node, and the number of links never grows. A round's links are written to the shared folder, so the plan stays
    short and a lost executor costs one round. Links of a node with itself and null ends say nothing.
    Rounds end when a round changes no link; chains need a logarithmic number of them.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = staged(links.select("a", "b").filter("a <> b").distinct(), name)
    before, seen = None, state(now)
    while seen != before and seen[0]:
        now = staged(_small_star(_large_star(now).distinct()).filter("a <> b").distinct(), name)
        before, seen = seen, state(now)
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
