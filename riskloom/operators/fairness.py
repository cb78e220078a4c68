"""Recall by subgroup and quality gates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.config import QualityGates
from riskloom.functions.scoring import ratio_or_zero
from riskloom.session import settle

MAX_GAP = "max_recall_gap"


def subgroup_recalls(
    predictions: DataFrame, columns: Iterable[str], y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    """``(group_column, group_value, n_positive, recall)`` for several columns in one scan.

    Nulls form the group ``nan``. A group without positives has recall 0; ``n_positive``
    tells the two apart. Absent columns are skipped.
    """
    present = [c for c in columns if c in predictions.columns]
    wide = predictions.select(
        F.col(y).cast("bigint").alias("_y"),
        F.col(yhat).cast("bigint").alias("_yhat"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias(c) for c in present],
    )
    return (
        wide.unpivot(["_y", "_yhat"], present, "group_column", "group_value")
        .groupBy("group_column", "group_value")
        .agg(
            F.sum("_y").alias("n_positive"),
            ratio_or_zero(F.sum(F.col("_y") * F.col("_yhat")), F.sum("_y")).alias("recall"),
        )
    )


def recall_gaps(recalls: DataFrame, columns: Iterable[str] = ()) -> DataFrame:
    """``(group_column, max_recall_gap)``; a listed column without groups has gap 0."""
    gaps = recalls.groupBy("group_column").agg(
        (F.max("recall") - F.min("recall")).alias(MAX_GAP)
    )
    columns = list(columns)
    if not columns:
        return gaps
    named = recalls.sparkSession.createDataFrame([(c,) for c in columns], "group_column string")
    return named.join(gaps, "group_column", "left").fillna(0.0, [MAX_GAP])


def fairness_report(
    predictions: DataFrame, columns: Iterable[str], y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    """Recall of every subgroup, and the gap of its column beside it."""
    # Settled, so that gaps and recalls come from one scan of the rows.
    recalls = settle(subgroup_recalls(predictions, columns, y, yhat))
    # One row per column name.
    return recalls.join(F.broadcast(recall_gaps(recalls)), "group_column")


def _message(label: str, value: Column, side: str, limit: float) -> Column:
    return F.format_string(f"{label} %.4f {side} %.4f", value, F.lit(float(limit)))


def quality_gate_violations(metrics: DataFrame, gates: QualityGates) -> DataFrame:
    """``(gate, value, bound, message)`` for every violated gate of a one-row metric table.

    An absent or null metric counts as the worst value: 0 for areas and recall, 1 for Brier.
    """
    def metric(name: str, worst: float) -> Column:
        column = F.col(name).cast("double") if name in metrics.columns else F.lit(None).cast("double")
        return F.coalesce(column, F.lit(worst))

    pr_auc, recall, brier = metric("pr_auc", 0.0), metric("recall", 0.0), metric("brier_score", 1.0)
    checks = []
    for gate, value, limit, low, label in (
        ("min_pr_auc", pr_auc, gates.min_pr_auc, True, "PR-AUC"),
        ("min_recall", recall, gates.min_recall, True, "Recall"),
        ("max_brier_score", brier, gates.max_brier_score, False, "Brier score"),
    ):
        if limit is None:
            continue
        bad = value < limit if low else value > limit
        text = _message(label, value, "below minimum" if low else "above maximum", limit)
        checks.append(
            F.when(
                bad,
                F.struct(
                    F.lit(gate).alias("gate"), value.alias("value"),
                    F.lit(float(limit)).alias("bound"), text.alias("message"),
                ),
            )
        )
    if not checks:
        return metrics.sparkSession.createDataFrame(
            [], "gate string, value double, bound double, message string"
        )
    return metrics.select(F.inline(F.array_compact(F.array(*checks))))


def gap_violations(gaps: DataFrame, gates: QualityGates) -> DataFrame:
    """Columns whose recall gap exceeds the allowed gap."""
    limit = gates.subgroup_max_recall_gap
    if limit is None:
        return gaps.limit(0).select("group_column", MAX_GAP, F.lit("").alias("message"))
    text = F.format_string(
        "Subgroup recall gap [%s] %.4f above maximum %.4f", "group_column", MAX_GAP, F.lit(float(limit))
    )
    return gaps.filter(F.col(MAX_GAP) > limit).select("group_column", MAX_GAP, text.alias("message"))


def align_by_key(predictions: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Predictions beside their group columns, matched by row key rather than position."""
    return predictions.join(groups, key, "inner")
