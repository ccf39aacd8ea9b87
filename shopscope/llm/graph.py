"""Connected components of a link table, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.session import stored


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): every node that has a link, with the least node of its component.

    ``links`` has columns ``a`` and ``b``. Alternates "every larger neighbour links to the least neighbour" and "every smaller neighbour
    does", which shortens paths without ever gathering a node's neighbours: only a minimum per node is shuffled.
    Every round is written to the shared folder; rounds end when the table no longer changes.
    """
    edges = stored(links.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
        # Large star: neighbours above a node link to the least of the node and its neighbours.
        large = both.filter("b > a").join(least, F.col("a") == F.col("node")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: neighbours below a node link to the least among them, and so does the node.
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "node")
        small = large.join(low, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select(F.col("node").alias("a"), F.col("m").alias("b"))).filter("a != b").distinct()
        new = stored(small, "edges")
        if new.count() == edges.count() and new.exceptAll(edges).isEmpty():
            break
        edges = new
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return new.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        new.select("b", "b").distinct())
