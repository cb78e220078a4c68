"""Distinct-value tables: the one pass over raw rows that most statistics share.

Medians, quartiles, modes, vocabularies, histograms, PSI and KS all follow from
``(feature, value, n)``. The unpivot is folded into the map-side partial aggregate,
so only distinct values are shuffled, and a value that fills a third of the rows
costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import sqltext
from riskloom.operators.running import ranged, running_totals


def unpivot(
    df: DataFrame, columns: Iterable[str], kind: str, keep: Iterable[str] = ()
) -> DataFrame:
    """Long form ``(keep..., feature, value)`` with every value cast to ``kind``."""
    keep = list(keep)
    columns = list(columns)
    wide = df.select(*keep, *[F.col(f"`{c}`").cast(kind).alias(c) for c in columns])
    return wide.unpivot(keep, columns, "feature", "value")


def numeric_counts(
    df: DataFrame,
    columns: Iterable[str],
    measures: Mapping[str, Column] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """``(feature, value, n)`` of the values present, or the given measures instead of ``n``."""
    keep = list(keep)
    measures = measures or {"n": F.count(F.lit(1))}
    long = unpivot(df, columns, "double", keep).filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    return long.groupBy("feature", "value").agg(
        *[m.cast("bigint").alias(name) for name, m in measures.items()]
    )


def text_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``(feature, value, n)`` for categories, nulls left out."""
    long = unpivot(df, columns, "string").filter(F.col("value").isNotNull())
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def ranged_counts(counts: DataFrame) -> DataFrame:
    """A table of distinct values, stored in order: all statistics of it start here."""
    return ranged(counts, "value", ["feature"])


def order_statistics(
    counts: DataFrame, shares: Mapping[str, float], settled: bool = False
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per feature.

    The value at 0-based rank r is the one whose running count first exceeds r. ``settled``
    counts are :func:`ranged_counts`.
    """
    counts = counts if settled else ranged_counts(counts)
    ranked = running_totals(counts, "value", ["n"], ["feature"])
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    # One row per feature name.
    placed = ranked.join(F.broadcast(totals), "feature")
    low_edge, high_edge = F.col("cum_n") - F.col("n"), F.col("cum_n")

    def at(rank: Column) -> Column:
        return F.max(F.when((low_edge <= rank) & (rank < high_edge), F.col("value")))

    picks, out = [], []
    for name, share in shares.items():
        position = (F.col("total") - 1) * F.lit(float(share))
        low = F.floor(position)
        picks += [
            at(low).alias(f"_{name}_low"),
            at(F.least(low + 1, F.col("total") - 1)).alias(f"_{name}_high"),
        ]
        part = position - low
        lo, hi = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        out.append((lo + (hi - lo) * part).alias(name))
    return placed.groupBy("feature", "total").agg(*picks).select("feature", "total", *out)


def column_ranges(df: DataFrame, columns: Iterable[str]) -> dict[str, tuple[float, float, int]]:
    """Smallest and largest value and number of values of each column, by one wide aggregate.

    Columns without any value are left out. NaN counts as missing.
    """
    columns = list(columns)
    aggregates = []
    for i, c in enumerate(columns):
        v = f"nanvl(double({sqltext.name(c)}), NULL)"
        aggregates += [
            F.expr(f"min({v})").alias(f"lo{i}"),
            F.expr(f"max({v})").alias(f"hi{i}"),
            F.expr(f"count({v})").alias(f"n{i}"),
        ]
    row = df.agg(*aggregates).first()
    return {
        c: (row[f"lo{i}"], row[f"hi{i}"], row[f"n{i}"])
        for i, c in enumerate(columns)
        if row[f"n{i}"]
    }


def bin_counts(
    df: DataFrame, ranges: Mapping[str, tuple[float, float]], bins: int,
    measures: Mapping[str, Column] | None = None, keep: Iterable[str] = (),
) -> DataFrame:
    """``(feature, bin, n)`` of equal-width bins with known ranges.

    Every value becomes its bin number before the unpivot, so the shuffle carries at most
    features x bins rows per task however many distinct values there are.
    """
    keep = list(keep)
    measures = measures or {"n": F.count(F.lit(1))}
    placed = []
    for c, (low, high) in ranges.items():
        v = f"nanvl(double({sqltext.name(c)}), NULL)"
        step = (high - low) / bins
        edges = [] if low == high else [low + i * step for i in range(1, bins)]
        index = " + ".join(f"int({v} >= {sqltext.value(e)})" for e in edges) or "0"
        placed.append(f"IF({v} IS NULL, NULL, {index}) AS {sqltext.name(c)}")
    long = df.selectExpr(*keep, *placed).unpivot(keep, list(ranges), "feature", "bin")
    return long.filter(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(
        *[m.cast("bigint").alias(name) for name, m in measures.items()]
    )


def equal_width_bin(value: str, low: str, high: str, bins: int) -> Column:
    """Index of the equal-width bin: how many inner edges lie at or below the value.

    Edges are ``low + i * step`` with the step computed first; the last bin is closed on
    the right. A range of a single value has one bin, number 0.
    """
    step = f"(({high} - {low}) / {float(bins)}D)"
    inner = f"filter(sequence(1, {bins - 1}), i -> {value} >= {low} + i * {step})"
    return F.expr(f"IF({low} = {high} OR {bins} = 1, 0, size({inner}))")
