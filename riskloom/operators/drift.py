"""Distribution drift between a reference and a current table.

Both sides are reduced in one scan each to ``(feature, value, n_ref, n_cur)``. PSI and
KS are then computed for all features together from that table of distinct values.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskloom.functions import sqltext
from riskloom.operators.counts import (
    bin_counts, column_ranges, equal_width_bin, numeric_counts, ranged_counts,
)
from riskloom.operators.running import running_totals
from riskloom.schema import NUMERIC_FEATURES
from riskloom.session import settle

PSI_FLOOR = 1e-4
PSI_LIMIT = 0.2
KS_ALPHA = 0.05
PSI_BINS = 10
KS_TERMS = 100
# Largest sample whose p-value is exact.
EXACT_ROWS = 10_000


def shared_features(
    reference: DataFrame, current: DataFrame, features: Iterable[str] | None = None
) -> list[str]:
    """Features present on both sides, in the order asked for."""
    return [f for f in (features or NUMERIC_FEATURES) if f in reference.columns and f in current.columns]


def _both_sides(reference: DataFrame, current: DataFrame, names: list[str]) -> DataFrame:
    """Rows of both tables with a side marker, features as doubles."""
    def side(df: DataFrame, number: int) -> DataFrame:
        return df.selectExpr(
            f"{number} AS _side", *[f"double({sqltext.name(c)}) AS {sqltext.name(c)}" for c in names]
        )

    return side(reference, 0).unionByName(side(current, 1))


def _side_measures() -> dict[str, Column]:
    return {
        "n_ref": F.count_if(F.col("_side") == 0),
        "n_cur": F.count_if(F.col("_side") == 1),
    }


def paired_counts(
    reference: DataFrame, current: DataFrame, features: Iterable[str] | None = None
) -> DataFrame:
    """``(feature, value, n_ref, n_cur)`` of the shared features, nulls left out."""
    names = shared_features(reference, current, features)
    if not names:
        return reference.sparkSession.createDataFrame(
            [], "feature string, value double, n_ref bigint, n_cur bigint"
        )
    both = _both_sides(reference, current, names)
    return numeric_counts(both, names, _side_measures(), keep=["_side"])


def reference_counts(reference: DataFrame, features: Iterable[str] | None = None) -> DataFrame:
    """Reference half of the paired counts, kept for repeated checks against it."""
    names = [f for f in (features or NUMERIC_FEATURES) if f in reference.columns]
    return settle(numeric_counts(reference, names))


def add_current(
    stored: DataFrame, current: DataFrame, features: Iterable[str] | None = None
) -> DataFrame:
    """Paired counts of stored reference counts and a current table."""
    names = [f for f in (features or NUMERIC_FEATURES) if f in current.columns]
    old = stored.filter(F.col("feature").isin(names)).withColumn("_side", F.lit(0))
    both = old.unionByName(numeric_counts(current, names).withColumn("_side", F.lit(1)))
    return both.groupBy("feature", "value").agg(
        *[
            F.sum(F.when(F.col("_side") == side, F.col("n")).otherwise(0)).alias(name)
            for side, name in enumerate(("n_ref", "n_cur"))
        ]
    )


def _feature_totals(pairs: DataFrame) -> DataFrame:
    """Extremes and sizes per feature; a feature with an empty side is left out."""
    return (
        pairs.groupBy("feature")
        .agg(
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
            F.sum("n_ref").alias("total_ref"),
            F.sum("n_cur").alias("total_cur"),
        )
        .filter("total_ref > 0 AND total_cur > 0")
    )


def psi_from_counts(pairs: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """``(feature, psi)`` over equal bins of the combined range."""
    totals = _feature_totals(pairs)
    placed = pairs.join(F.broadcast(totals), "feature").withColumn(
        "bin", equal_width_bin("value", "lo", "hi", bins)
    )
    filled = placed.groupBy("feature", "bin", "total_ref", "total_cur").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )
    return _psi_of_bins(filled)


def _psi_of_bins(bins: DataFrame) -> DataFrame:
    """PSI from ``(feature, n_ref, n_cur, total_ref, total_cur)`` per filled bin.

    A bin that is empty on both sides adds nothing: both shares are the floor. A constant
    feature has a single bin, full on both sides, and so 0.
    """
    share = {
        side: F.when(F.col(f"n_{side}") == 0, F.lit(PSI_FLOOR)).otherwise(
            F.col(f"n_{side}") / F.col(f"total_{side}")
        )
        for side in ("ref", "cur")
    }
    term = (share["cur"] - share["ref"]) * F.ln(share["cur"] / share["ref"])
    return bins.groupBy("feature").agg(F.sum(term).alias("psi"))


def ks_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Limiting two-sided p-value of the two-sample statistic.

    ``2 * sum((-1)^(k-1) * exp(-2 k^2 x^2))`` with ``x = D * sqrt(n m / (n + m))``. The
    series is cut after 100 terms, which is exact to double precision from x = 0.05 up;
    below that the p-value is 1.
    """
    n, m = n.cast("double"), m.cast("double")
    x = statistic * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * x * x),
    )
    return F.when(x < 0.05, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


def lattice_p_value(n: int, m: int, gap: int) -> float:
    """Chance that samples of ``n`` and ``m`` values of one distribution differ by ``gap / (n m)``.

    An order of the pooled values is a path from (0, 0) to (n, m), and all paths are equally
    likely. They are followed together, one value at a time: a path at (i, j) takes its next
    value from the first sample with chance ``(n - i) / (n + m - i - j)``, and is counted and
    left as soon as ``|i m - j n|`` reaches ``gap``.
    """
    if gap <= 0:
        return 1.0
    n, m = min(n, m), max(n, m)
    alive, gone = np.ones(1), 0.0
    low = 0  # of the first sample, the fewest values of a path that goes on
    for step in range(n + m):
        i = np.arange(low, low + len(alive))
        left = n + m - step
        first, second = alive * (n - i) / left, alive * (m - (step - i)) / left
        alive = np.append(second, 0.0)
        alive[1:] += first
        i = np.arange(low, low + len(alive))
        out = np.abs(i * m - (step + 1 - i) * n) >= gap
        gone += float(alive[out].sum())
        inside = np.flatnonzero(~out)
        if not len(inside):
            break
        # Gaps grow away from the middle, so what goes on is one run.
        alive, low = alive[inside[0] : inside[-1] + 1], low + int(inside[0])
    return min(gone, 1.0)


@F.pandas_udf(T.DoubleType())
def _exact_p_value(statistic: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    rows = zip(statistic, n, m)
    return pd.Series([lattice_p_value(int(a), int(b), round(d * a * b)) for d, a, b in rows], dtype=float)


def ks_from_counts(pairs: DataFrame, settled: bool = False, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """``(feature, ks_statistic, ks_p_value)``: the largest gap of the two step functions.

    The p-value is exact where neither side has more than ``exact_rows`` values, and that of the
    limiting distribution elsewhere. Exact values need a row per feature, not the data.
    """
    pairs = pairs if settled else ranged_counts(pairs)
    ranked = running_totals(pairs, "value", ["n_ref", "n_cur"], ["feature"])
    totals = _feature_totals(pairs)
    gap = F.abs(
        F.col("cum_n_ref") / F.col("total_ref") - F.col("cum_n_cur") / F.col("total_cur")
    )
    sizes = F.col("total_ref"), F.col("total_cur")
    tested = (
        ranked.join(F.broadcast(totals), "feature")
        .groupBy("feature", "total_ref", "total_cur")
        .agg(F.max(gap).alias("ks_statistic"))
        .withColumn("ks_p_value", ks_p_value(F.col("ks_statistic"), *sizes))
    )
    if exact_rows > 0:
        small = F.greatest(*sizes) <= exact_rows
        # A Python function runs for every row it is given, so large samples go in as empty ones.
        given = [F.when(small, c).otherwise(0) for c in (F.col("ks_statistic"), *sizes)]
        tested = tested.withColumn("ks_p_value", F.when(small, _exact_p_value(*given)).otherwise(F.col("ks_p_value")))
    return tested.select("feature", "ks_statistic", "ks_p_value")


def compute_psi(
    reference: DataFrame, current: DataFrame, features: Iterable[str] | None = None,
    bins: int = PSI_BINS,
) -> DataFrame:
    """PSI on its own: extremes by one wide aggregate per side, then bin counts.

    Needs no distinct values, so continuous features cost no more than counts.
    """
    names = shared_features(reference, current, features)
    old, new = column_ranges(reference, names), column_ranges(current, names)
    both = [c for c in names if c in old and c in new]
    spark = reference.sparkSession
    if not both:
        return spark.createDataFrame([], "feature string, psi double")
    ranges = {c: (min(old[c][0], new[c][0]), max(old[c][1], new[c][1])) for c in both}
    counted = bin_counts(
        _both_sides(reference, current, both), ranges, bins, _side_measures(), keep=["_side"]
    )
    sizes = spark.createDataFrame(
        [(c, old[c][2], new[c][2]) for c in both],
        "feature string, total_ref bigint, total_cur bigint",
    )
    return _psi_of_bins(counted.join(F.broadcast(sizes), "feature"))  # a row per feature


def compute_ks_tests(
    reference: DataFrame, current: DataFrame, features: Iterable[str] | None = None, exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    return ks_from_counts(paired_counts(reference, current, features), exact_rows=exact_rows)


def detect_drift(
    reference: DataFrame,
    current: DataFrame,
    features: Iterable[str] | None = None,
    psi_threshold: float = PSI_LIMIT,
    ks_alpha: float = KS_ALPHA,
    bins: int = PSI_BINS,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """One row per shared feature: scores, both flags, and their union."""
    pairs = ranged_counts(paired_counts(reference, current, features))
    return drift_from_counts(pairs, psi_threshold, ks_alpha, bins, exact_rows)


def drift_from_counts(
    pairs: DataFrame, psi_threshold: float = PSI_LIMIT, ks_alpha: float = KS_ALPHA,
    bins: int = PSI_BINS, exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """Drift report of paired counts stored in order."""
    joined = psi_from_counts(pairs, bins).join(
        F.broadcast(ks_from_counts(pairs, True, exact_rows)), "feature"
    )
    flag_psi, flag_ks = F.col("psi") > psi_threshold, F.col("ks_p_value") < ks_alpha
    return joined.select(
        "feature", "psi", "ks_statistic", "ks_p_value",
        flag_psi.alias("flag_psi"), flag_ks.alias("flag_ks"), (flag_psi | flag_ks).alias("drifted"),
    )


def drift_summary(report: DataFrame) -> DataFrame:
    """One row: how many features drifted, and whether any did."""
    return report.agg(
        F.count_if("drifted").alias("n_features_drifted"),
        F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("drift_detected"),
    )


def drift_check(
    reference: DataFrame, current: DataFrame, features: Iterable[str] | None = None, exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """A row for every asked feature of the current table, neutral where no reference exists."""
    asked = [f for f in (features or NUMERIC_FEATURES) if f in current.columns]
    named = current.sparkSession.createDataFrame([(f,) for f in asked], "feature string")
    report = detect_drift(reference, current, asked, exact_rows=exact_rows)
    # One row per feature name.
    return named.join(F.broadcast(report), "feature", "left").select(
        "feature",
        F.coalesce("psi", F.lit(0.0)).alias("psi_score"),
        F.coalesce("ks_statistic", F.lit(0.0)).alias("ks_statistic"),
        F.coalesce("ks_p_value", F.lit(1.0)).alias("ks_p_value"),
        F.coalesce("drifted", F.lit(False)).alias("drifted"),
    )
