"""What both vector searches do first: usable vectors, and one row per distinct vector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def usable(vector: Column) -> Column:
    """Neither null nor empty, and every component a finite number."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def classes(vectors: DataFrame, members: int) -> DataFrame:
    """One row per distinct ``_v``: ``_class`` (its smallest id) and its ``members`` smallest ids.

    Equal vectors score alike, so with ties going to smaller ids no other member can reach a
    result of ``members`` rows. The rank filter runs ahead of the shuffle as well, so a vector
    that a third of all rows hold sends a few ids per task.
    """
    order = Window.partitionBy("_v").orderBy("_id")
    return (
        vectors.groupBy("_v", "_id").agg(F.lit(1).alias("_one"))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= members)
        .groupBy("_v")
        .agg(F.array_sort(F.collect_list("_id")).alias("_members"))
        .withColumn("_class", F.element_at("_members", 1))
    )


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest scores per query, ties to the smaller id, ranked from 1."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
