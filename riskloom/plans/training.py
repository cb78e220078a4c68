"""The training job: raw encounters in, artifacts and a report out."""

from __future__ import annotations

import json
import warnings
from dataclasses import asdict, dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.config import TrainingConfig
from riskloom.operators import attribution, cleaning, encoding, fairness, features, scores, splits
from riskloom.plans import models
from riskloom.plans.evaluation import evaluate_scored
from riskloom.schema import FAIRNESS_COLUMNS, TARGET
from riskloom.session import settle, stored
from riskloom.sources import artifacts
from riskloom.sources.checks import validate_data

KEY = "encounter_id"


def prepare(raw: DataFrame) -> DataFrame:
    """Checked, engineered, deduplicated and cleaned rows, keyed by encounter.

    Features depend on one row only, so they are computed ahead of the deduplication:
    its shuffle then carries the model columns instead of all raw ones.
    """
    engineered = features.run_feature_engineering(validate_data(raw))
    return cleaning.clean_data(cleaning.deduplicate_patients(engineered), keep=[KEY])


def fingerprint(
    spark: SparkSession, config: TrainingConfig, n_rows: int, n_features: int, best: str
) -> str:
    """First 12 hex digits of the SHA-256 of the run's settings and sizes."""
    settings = {k: v for k, v in asdict(config).items() if k not in ("models", "gates")}
    body = json.dumps(
        {
            "training_cfg": settings,
            "n_train_samples": n_rows,
            "n_features": n_features,
            "best_model": best,
        },
        sort_keys=True,
    )
    return fingerprint_of(spark.createDataFrame([(body,)], "body string")).first()[0]


def fingerprint_of(table: DataFrame, column: str = "body") -> DataFrame:
    return table.select(F.substring(F.sha2(F.col(column), 256), 1, 12).alias("fingerprint"))


def run_row(run: str, model: str, params: dict, metrics: dict) -> list[tuple]:
    """Run-table rows ``(run_id, model, kind, name, value)`` of one fitted candidate."""
    rows = [(run, model, "param", k, str(v)) for k, v in params.items()]
    return rows + [(run, model, "metric", k, repr(v)) for k, v in metrics.items() if v is not None]


RUN_SCHEMA = "run_id string, model string, kind string, name string, value string"


@dataclass(frozen=True)
class TrainingResult:
    best_model: str
    metrics: dict[str, float]
    threshold: float
    quality_gate_violations: list[str]
    fingerprint: str
    calibrated: bool
    cv_pr_auc: dict[str, float]


def train_and_log_model(
    candidate: models.Candidate, train: DataFrame, val: DataFrame, label: str = TARGET, seed: int = 42
) -> tuple[object, dict[str, float]]:
    """Fit one candidate and measure it on the validation rows at 0.5."""
    model = candidate.fit(train, label, seed)
    scored = models.probability(model, val).select(F.col(label).alias("y"), "p")
    metrics = scores.compute_metrics(scored).first().asDict()
    metrics.pop("brier_score")
    return model, metrics


def run_training(raw: DataFrame, out: str, config: TrainingConfig = TrainingConfig()) -> TrainingResult:
    """Prepare, split, encode, tune, rank, refit, calibrate, choose a cut, report."""
    spark = raw.sparkSession
    seed, paths = config.random_state, artifacts.new_run(out)
    table = stored(prepare(raw), "prepared")
    assigned = splits.assign_splits(
        table, KEY, TARGET, config.test_size, config.val_size, seed
    )
    numeric, categorical = cleaning.feature_columns(table)
    train_rows = assigned.filter("split = 'train'")
    encoder = encoding.TabularEncoder(numeric, categorical).fit(train_rows)
    names = encoding.feature_names(encoder)
    groups = [c for c in FAIRNESS_COLUMNS if c in table.columns]
    encoded = stored(
        encoding.encode(encoder, assigned, [KEY, TARGET, "split", *groups]), "encoded", "split"
    )
    part = {s: encoded.filter(F.col("split") == s) for s in ("train", "val", "test")}
    # The folds of all candidates and of the threshold, located once; a fold is a folder.
    train_val = stored(
        splits.assign_folds(encoded.filter("split <> 'test'"), KEY, TARGET, config.cv_folds, seed), "folds", "fold"
    )

    runs, trained, cv, val_pr = [], {}, {}, {}
    for name, candidate in models.configured_models(config).items():
        if name in models.BOOSTED and config.n_trials > 0:
            candidate, trials = models.tune(name, part["train"], part["val"], config)
            runs += [
                (f"trial-{r['trial']}", name, "trial", r["name"], repr(r["value"]))
                for r in trials.collect()  # trials x 7 rows
            ]
        fitted, metrics = train_and_log_model(candidate, part["train"], part["val"], TARGET, seed)
        artifacts.save_model(fitted, paths.candidate(name), spark)
        runs += run_row("fit", name, dict(candidate.params), metrics)
        trained[name], val_pr[name] = candidate, metrics["pr_auc"]
        cv[name] = models.cross_validated_pr_auc(
            train_val, lambda d, c=candidate: c.fit(d, TARGET, seed), KEY, TARGET, config.cv_folds, seed
        )
        runs += run_row("cv", name, {}, {"cv_pr_auc": cv[name]})
    order = spark.createDataFrame(
        [(n, i, cv[n]) for i, n in enumerate(trained)], "model string, position int, score double"
    )
    best = scores.best_model(order).first()["model"]
    candidate = trained[best]

    margin_model = candidate.fit(train_val, TARGET, seed)
    try:
        model, calibrated = _calibrate(candidate, margin_model, part, train_val, config)
    except Exception as error:  # a model without calibration is still one
        warnings.warn(f"calibration failed, the uncalibrated model is kept: {error}", stacklevel=2)
        model, calibrated = margin_model, False

    def refit(rows: DataFrame):
        if calibrated:
            return models.fit_calibrated(rows, candidate, KEY, TARGET, config.calibration_folds, seed)
        return candidate.fit(rows, TARGET, seed)

    threshold = models.cross_validated_threshold(
        train_val, refit, KEY, config.threshold_min_recall, TARGET, config.cv_folds, seed
    )
    n_rows = train_val.count()
    mark = fingerprint(spark, config, n_rows, len(names), best)

    scored = settle(
        models.probability(model, part["test"]).select(KEY, F.col(TARGET).alias("y"), "p", *groups)
    )
    tables = evaluate_scored(scored, threshold)
    metrics = tables["metrics"].first().asDict()
    flagged = scored.withColumn("yhat", (F.col("p") >= threshold).cast("int"))
    recalls = fairness.fairness_report(flagged, groups)
    violations = [r["message"] for r in fairness.quality_gate_violations(tables["metrics"], config.gates).collect()]
    gaps = fairness.recall_gaps(recalls)
    violations += [r["message"] for r in fairness.gap_violations(gaps, config.gates).collect()]

    encoder.write().overwrite().save(paths.encoder)
    artifacts.save_model(model, paths.model, spark)
    artifacts.save_model(margin_model, paths.margin, spark)
    background = (
        attribution.feature_means(train_val)
        if isinstance(margin_model, LogisticRegressionModel)
        else []
    )
    artifacts.save_reference(assigned.filter("split <> 'test'"), numeric, paths.reference)
    spark.createDataFrame(runs, RUN_SCHEMA).write.mode("overwrite").parquet(paths.runs)
    artifacts.save_metrics_report(
        spark, paths.report, metrics, threshold,
        {
            "best_model": best,
            "calibrated": calibrated,
            "training_fingerprint": mark,
            "validation_pr_auc": val_pr[best],
            "cv_pr_auc": cv[best],
            "quality_gate_violations": violations,
            "subgroup_fairness": _nested(recalls),
            "model_version": config.model_version,
            "feature_names": names,
            "background": background,
        },
    )
    artifacts.save_threshold(spark, paths.threshold, threshold, config.threshold_min_recall, mark)
    for name, table in tables.items():
        table.write.parquet(f"{paths.evaluation}/{name}")
    _importance(margin_model, train_val, names, background, config).write.parquet(paths.importance)
    artifacts.publish_run(spark, out, paths)
    return TrainingResult(best, metrics, threshold, violations, mark, calibrated, cv)


def _importance(model, rows: DataFrame, names: list[str], background: list[float], config: TrainingConfig) -> DataFrame:
    """Mean absolute contribution per feature, over all rows or the configured sample."""
    if config.importance_rows is not None:
        rows = splits.hash_sample(rows, KEY, config.importance_rows, config.random_state)
    if isinstance(model, LogisticRegressionModel):
        explained = attribution.linear_contributions(
            rows, vector_to_array("features"), model.coefficients.toArray().tolist(), background
        )
    else:
        explained = attribution.tree_contributions(rows, attribution.read_forest(rows, model))
    return attribution.global_importance(explained, names)


def _calibrate(candidate, margin_model, part, train_val, config: TrainingConfig):
    """Calibrated model if its Brier score is lower on the configured part."""
    def brier(model, rows: DataFrame) -> float:
        scored = models.probability(model, rows)
        return float(scores.brier_score(scored, TARGET, "p").first()["brier_score"])

    folds, seed = config.calibration_folds, config.random_state
    calibrated = models.fit_calibrated(train_val, candidate, KEY, TARGET, folds, seed)
    if config.calibration_check == "test":
        better = brier(calibrated, part["test"]) < brier(margin_model, part["test"])
    else:
        # Judge on validation rows with both models fitted on training rows only.
        plain = candidate.fit(part["train"], TARGET, seed)
        trial = models.fit_calibrated(part["train"], candidate, KEY, TARGET, folds, seed)
        better = brier(trial, part["val"]) < brier(plain, part["val"])
    return (calibrated, True) if better else (margin_model, False)


def _nested(report: DataFrame) -> dict[str, dict[str, float]]:
    """Fairness report as nested dictionaries; its rows are groups, not data."""
    out: dict[str, dict[str, float]] = {}
    for r in report.collect():
        column = out.setdefault(r["group_column"], {})
        column[r["group_value"]] = r["recall"]
        column[fairness.MAX_GAP] = r[fairness.MAX_GAP]
    return out
