"""Running totals over a whole table, without pulling it into one task.

Inputs are already reduced to distinct keys. They are range-partitioned by group and order, so
a partition holds neighbouring keys and a group of any size is spread over as many partitions
as it fills. Totals per partition and group give each its starting value, and the window then
runs inside a partition. One plan serves every number of rows and of groups.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.session import stored


RANGE_COLUMNS = ("_key", "_range")


def ranged(df: DataFrame, order: str, group: Iterable[str] = ()) -> DataFrame:
    """``df`` stored in ranges of group and order, with its columns and ``_key``, ``_range``.

    The one stored form of a table of distinct keys: totals and other sums read it as well, so
    callers need not settle the table first. The range shuffle samples what an earlier shuffle
    has written, so the rows behind it are not computed anew.
    """
    group = list(group)
    return stored(
        df.withColumn("_key", F.struct(*group) if group else F.struct(F.lit(0)))
        .repartitionByRange("_key", order)
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )


def running_totals(
    df: DataFrame, order: str, sums: Iterable[str], group: Iterable[str] = ()
) -> DataFrame:
    """Add ``cum_<c>``: the sum of ``c`` over rows of the group up to and including this one.

    ``(group, order)`` must be unique and ``order`` not null. ``df`` may be :func:`ranged` already.
    """
    sums, group = list(sums), list(group)
    placed = df if set(RANGE_COLUMNS) <= set(df.columns) else ranged(df, order, group)
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # A row per group, and one more for each partition that a group goes on in.
    starts = (
        placed.groupBy("_key", "_range")
        .agg(*[F.sum(c).alias(f"_total_{c}") for c in sums])
        .select(
            "_key", "_range",
            *[F.coalesce(F.sum(f"_total_{c}").over(before), F.lit(0)).alias(f"_start_{c}") for c in sums],
        )
    )
    inside = Window.partitionBy("_key", "_range").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        placed.withColumns({f"cum_{c}": F.sum(c).over(inside) for c in sums})
        .join(starts, ["_key", "_range"])
        .withColumns({f"cum_{c}": F.col(f"cum_{c}") + F.col(f"_start_{c}") for c in sums})
        .drop(*RANGE_COLUMNS, *[f"_start_{c}" for c in sums])
    )
