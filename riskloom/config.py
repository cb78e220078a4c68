"""Settings of the training, evaluation and scoring jobs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class QualityGates:
    min_pr_auc: float | None = 0.10
    min_recall: float | None = 0.70
    max_brier_score: float | None = 0.30
    subgroup_max_recall_gap: float | None = 0.20


@dataclass(frozen=True)
class TrainingConfig:
    """Defaults follow the published configuration; lower the costs for trial runs."""

    test_size: float = 0.15
    val_size: float = 0.15
    random_state: int = 42
    n_trials: int = 50
    threshold_min_recall: float = 0.70
    cv_folds: int = 5
    calibration_folds: int = 3
    logistic_iterations: int = 1000
    forest_trees: int = 200
    forest_depth: int = 10
    boosted_tree_range: tuple[int, int] = (100, 1000)
    boosted_depth_range: tuple[int, int] = (3, 10)
    parallel_trials: int = 2
    # Rows whose contributions make the stored importances; None takes all of them.
    importance_rows: int | None = None
    # "validation" keeps the test set untouched; "test" is the published rule.
    calibration_check: str = "validation"
    models: tuple[str, ...] = (
        "logistic_regression", "random_forest", "xgboost", "lightgbm",
    )
    gates: QualityGates = field(default_factory=QualityGates)
    model_version: str = "riskloom-1"
