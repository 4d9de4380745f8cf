"""Connected components by alternating stars, over edges of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.llm.common import materialize


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node hang on the least of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _least_neighbour(both).select("a", F.least("a", "low").alias("low"))
    moved = both.filter("b > a").join(low, "a")
    return moved.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and itself, hang on the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _least_neighbour(down)
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(low.select("a", F.col("low").alias("b"))).filter("a <> b").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other, on which nothing else than leaves hang."""
    leaf = F.struct(F.col("a").alias("node"), F.col("b").alias("root"))
    root = F.struct(F.col("b").alias("node"), F.lit(None).cast("binary").alias("root"))
    ends = edges.select(F.explode(F.array(leaf, root)).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count_if(F.col("root").isNull()).alias("held")
    )
    return nodes.filter("low <> high OR (low IS NOT NULL AND held > 0)").isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """``a``, ``root``: for every node with an edge the least node of its component.

    ``edges`` has binary columns ``a`` and ``b``. Each round is written to the
    shared folder; the number of rounds grows with the logarithm of the longest
    path.
    """
    stars = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "stars"
    )
    while not _are_stars(stars):
        stars = materialize(_small_star(_large_star(stars)), "stars")
    roots = stars.select("b").distinct().select(F.col("b").alias("a"), F.col("b").alias("root"))
    return stars.select("a", F.col("b").alias("root")).unionAll(roots)
