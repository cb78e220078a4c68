"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import keep


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``(node, component)``: the smallest node each linked node reaches.

    ``links`` holds pairs of longs ``(a, b)``. Every round writes its links to the shared
    folder, sums minima ahead of each shuffle, and ends when the links are stars.
    """
    edges = keep(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: larger neighbours of a node go to its smallest one.
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        # Small star: a node and its smaller neighbours go to the smallest of them.
        small = large.join(lower, "a")
        nxt = keep(
            small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lower.select("a", F.col("m").alias("b"))).distinct(),
            "links",
        )
        if nxt.exceptAll(edges).isEmpty() and edges.exceptAll(nxt).isEmpty():
            break
        edges = nxt
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
