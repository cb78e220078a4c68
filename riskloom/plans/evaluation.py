"""Evaluation of a fitted model, and the job that ends with an exit status."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.config import TrainingConfig
from riskloom.operators import scores
from riskloom.plans import models
from riskloom.schema import TARGET
from riskloom.session import settle
from riskloom.sources import artifacts


def evaluate_scored(scored: DataFrame, threshold: float) -> dict[str, DataFrame]:
    """Metric row, confusion matrix and the three curve tables of ``(y, p)``.

    The distinct scores are counted and summed up once; metrics and curves read that table.
    """
    curve = scores.curve_of(scored)
    return {
        "metrics": settle(scores.compute_metrics(scored, threshold, curve=curve)),
        "confusion_matrix": scores.confusion_matrix(scored, threshold),
        "calibration_curve": scores.calibration_curve(scored),
        "roc_curve": scores.roc_points(scored, curve=curve),
        "pr_curve": scores.pr_points(scored, curve=curve),
    }


def evaluate_model(
    model, df: DataFrame, threshold: float, save_dir: str | None = None, label: str = TARGET,
    keep: Iterable[str] = (),
) -> dict[str, DataFrame]:
    """Score ``df`` once, then derive every report from the stored scores."""
    scored = settle(models.probability(model, df).select(F.col(label).alias("y"), "p", *keep))
    tables = evaluate_scored(scored, threshold)
    if save_dir is not None:
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{save_dir.rstrip('/')}/{name}")
    return tables


def run_evaluation(
    spark: SparkSession, raw: DataFrame, out: str, config: TrainingConfig = TrainingConfig(),
    train_if_missing: bool = False, fail_on_gates: bool = False,
) -> tuple[int, dict]:
    """Train and evaluate; returns an exit status and the report.

    With ``train_if_missing`` an existing artifact folder is reported as it is.
    """
    from riskloom.plans.training import run_training

    if not (train_if_missing and artifacts.artifacts_ready(spark, out)):
        run_training(raw, out, config)
    report = artifacts.load_metrics_report(spark, artifacts.current_run(spark, out).report) or {}
    failed = bool(report.get("quality_gate_violations"))
    return (1 if failed and fail_on_gates else 0), report
