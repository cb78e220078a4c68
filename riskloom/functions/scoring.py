"""Expressions on scores and counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def risk_tier(score: Column) -> Column:
    """Low below 0.3, Medium below 0.6, else High. Apply to the unrounded score."""
    return F.when(score < 0.3, "Low").when(score < 0.6, "Medium").when(score.isNotNull(), "High")


def decision(score: Column, threshold: float | Column) -> Column:
    """1 when the score reaches the threshold."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= cut).cast("int")


def round_score(score: Column, digits: int = 4) -> Column:
    """Score to a fixed number of decimals, halves of the scaled value to even."""
    scale = float(10**digits)
    return F.rint(score * F.lit(scale)) / F.lit(scale)


def ratio_or_zero(num: Column, den: Column) -> Column:
    """``num / den`` with 0 for an empty denominator."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
