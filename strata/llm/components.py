"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import discard, join_hot, stage


def _around(edges: DataFrame) -> DataFrame:
    """Each edge seen from both ends."""
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.unionAll(back)


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Every neighbour of a node above it, linked to the least of the node and its neighbours."""
    pairs = _around(edges)
    return join_hot(pairs, _least(pairs), ["a"], 2 * total).where("b > a").select(
        F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Every neighbour of a node below it, and the node itself, linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    others = join_hot(down, least, ["a"], total).where("b > m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).unionAll(others)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (node, root) per node that has an edge to another; root is the least node that
    it reaches. Edges with a null end and loops are left out; repeated edges count once.

    Each round is written to the shared folder and the one before it removed. Rounds grow with
    the logarithm of the longest path, not with its length. A node with many edges is summed
    on the map side; one with over a thousandth of all is broadcast to its edges."""
    now = stage(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
                .where(F.col("a") != F.col("b"))
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), "edges")
    seen = None
    while True:
        print_ = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(print_) == seen or not print_[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        seen = tuple(print_)
        total = print_[0]
        wide = stage(_large_star(now, total).distinct(), "edges")
        after = stage(_small_star(wide, total).distinct(), "edges")
        discard(wide)
        discard(now)
        now = after
