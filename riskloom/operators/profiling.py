"""Profiles of a table: missing values, summaries, shares, histograms, correlations."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import combinations

from pyspark.sql import DataFrame, functions as F, types as T

from riskloom.functions import sqltext
from riskloom.functions.scoring import ratio_or_zero, risk_tier
from riskloom.operators import counts
from riskloom.schema import RISK_TIERS
from riskloom.session import settle

OVERALL = "overall"


def null_report(df: DataFrame) -> DataFrame:
    """``(column, n_missing, pct)`` of columns with missing values, two decimals."""
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.expr(f"count(1) - count({sqltext.name(c)})").alias(c) for c in df.columns],
    )
    return (
        wide.unpivot(["_rows"], df.columns, "column", "n_missing")
        .filter("n_missing > 0")
        .select(
            "column", "n_missing",
            F.round(F.col("n_missing") / F.col("_rows") * 100, 2).alias("pct"),
        )
        .orderBy(F.col("pct").desc(), "column")
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def describe(
    df: DataFrame, columns: Iterable[str] | None = None
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column."""
    columns = list(columns or numeric_columns(df))
    table = counts.ranged_counts(counts.numeric_counts(df, columns))
    v, n = F.col("value"), F.col("n")
    means = table.groupBy("feature").agg(
        F.sum("n").alias("count"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    spread = (
        table.join(F.broadcast(means.select("feature", "mean")), "feature")
        .groupBy("feature")
        .agg(
            F.sqrt(F.try_divide(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))), F.sum("n") - 1))
            .alias("std")
        )
    )
    quartiles = counts.order_statistics(
        table, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, settled=True
    ).drop("total")
    return (
        means.join(spread, "feature")
        .join(quartiles, "feature")
        .select("feature", "count", "mean", "std", "min", "q25", "q50", "q75", "max")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n)`` without nulls."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def value_shares(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``(feature, value, n, pct)`` of several columns in one scan."""
    table = counts.text_counts(df, columns)
    totals = table.groupBy("feature").agg(F.sum("n").alias("total"))
    return table.join(F.broadcast(totals), "feature").select(
        "feature", "value", "n", (F.col("n") / F.col("total") * 100).alias("pct")
    )


def group_rates(df: DataFrame, columns: Iterable[str], target: str) -> DataFrame:
    """Target rate in percent per group of each column, and overall, in one scan.

    The row with column ``overall`` is the rate of all rows. Null groups are left out.
    """
    columns = list(columns)
    wide = df.select(
        F.col(target).cast("bigint").alias("_y"),
        F.lit("all").alias(OVERALL),
        *[F.col(c).cast("string").alias(c) for c in columns],
    )
    return (
        wide.unpivot(["_y"], [OVERALL, *columns], "group_column", "group_value")
        .filter(F.col("group_value").isNotNull())
        .groupBy("group_column", "group_value")
        .agg(F.count("_y").alias("n"), (F.avg("_y") * 100).alias("rate_pct"))
        .orderBy("group_column", F.col("rate_pct").desc(), "group_value")
    )


def histogram(df: DataFrame, columns: Iterable[str], bins: int = 30) -> DataFrame:
    """``(feature, bin, low, high, n)`` over equal bins between each column's extremes.

    One wide aggregate finds the extremes, a second pass counts bin numbers. A constant
    column is widened by one half on both sides.
    """
    ranges = {
        c: (lo, hi) if lo < hi else (lo - 0.5, hi + 0.5)
        for c, (lo, hi, _) in counts.column_ranges(df, columns).items()
    }
    edges = []
    for c, (lo, hi) in ranges.items():
        step = (hi - lo) / bins
        cuts = [lo + i * step for i in range(bins)] + [hi]
        edges += [(c, i, cuts[i], cuts[i + 1]) for i in range(bins)]
    grid = df.sparkSession.createDataFrame(edges, "feature string, bin int, low double, high double")
    if not ranges:
        return grid.withColumn("n", F.lit(0).cast("bigint"))
    filled = counts.bin_counts(df, ranges, bins)
    # Both sides hold at most columns x bins rows.
    return grid.join(F.broadcast(filled), ["feature", "bin"], "left").select(
        "feature", "bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n")
    )


def correlations(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Lower triangle ``(a, b, r)`` of the Pearson matrix, nulls dropped pair by pair.

    A single aggregate without a grouping key: each task keeps one small state per pair.
    """
    columns = list(columns or numeric_columns(df))
    pairs = [(b, a) for a, b in combinations(columns, 2)]
    wide = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])

    # corr() raises on a constant column under ANSI rules; the sums behind it do not.
    row = wide.agg(
        *[
            F.try_divide(
                F.regr_sxy(a, b), F.sqrt(F.regr_sxx(a, b)) * F.sqrt(F.regr_syy(a, b))
            ).alias(f"r{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    structs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*structs)))


def fold_summary(folds: DataFrame, metrics: Iterable[str], model: str = "model") -> DataFrame:
    """Mean and sample deviation of fold metrics per model, four decimals."""
    made = []
    for m in metrics:
        made += [
            F.round(F.avg(m), 4).alias(f"{m}_mean"),
            F.round(F.stddev_samp(m), 4).alias(f"{m}_std"),
        ]
    return folds.groupBy(model).agg(*made)


def fold_pivot(
    folds: DataFrame, models: Iterable[str], metric: str, model: str = "model", fold: str = "fold"
) -> DataFrame:
    """One row per fold, one column per model."""
    return folds.groupBy(fold).pivot(model, list(models)).agg(F.round(F.avg(metric), 4))


def type_counts(df: DataFrame) -> DataFrame:
    """Columns per type."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema]
    return (
        df.sparkSession.createDataFrame(rows, "name string, type string")
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def tier_counts(scored: DataFrame, p: str = "p") -> DataFrame:
    """Rows per risk tier; all three tiers are listed. One aggregate over the scores."""
    tier = risk_tier(F.col(p))
    wide = scored.agg(*[F.count_if(tier == t).alias(t) for t in RISK_TIERS])
    return wide.unpivot([], list(RISK_TIERS), "risk_tier", "n")


def class_balance(df: DataFrame, y: str = "y") -> DataFrame:
    """Rows, positives, positive rate and the negative-to-positive ratio."""
    label = F.col(y).cast("bigint")
    return df.agg(F.count(label).alias("n"), F.sum(label).alias("positives")).select(
        "n",
        "positives",
        ratio_or_zero(F.col("positives"), F.col("n")).alias("positive_rate"),
        ((F.col("n") - F.col("positives")) / F.greatest(F.col("positives"), F.lit(1))).alias(
            "positive_weight"
        ),
    )


def top_features(table: DataFrame, value: str, name: str = "feature", k: int = 20) -> DataFrame:
    """Largest ``k`` by value; names break ties. Runs as a top-k, not a sort."""
    return table.orderBy(F.col(value).desc(), F.col(name)).limit(k)
