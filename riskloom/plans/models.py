"""Candidate classifiers, out-of-fold scores, calibration and tuning on MLlib."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.config import TrainingConfig
from riskloom.operators import scores, splits
from riskloom.schema import TARGET
from riskloom.session import settle

FEATURES = "features"
WEIGHT = "_weight"
BOOSTED = ("xgboost", "lightgbm")


@dataclass(frozen=True)
class Balance:
    """Rows and positives of a training table."""

    rows: int
    positives: int

    def weight_column(self, label: str, positive_weight: float | None) -> Column:
        """Balanced class weights, or ``positive_weight`` for positives and 1 otherwise."""
        if positive_weight is not None:
            up, down = float(positive_weight), 1.0
        else:
            up = self.rows / (2 * max(self.positives, 1))
            down = self.rows / (2 * max(self.rows - self.positives, 1))
        return F.when(F.col(label) == 1, F.lit(up)).otherwise(F.lit(down))


def balance(df: DataFrame, label: str = TARGET) -> Balance:
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0))).first()
    return Balance(int(row[0]), int(row[1]))


@dataclass(frozen=True)
class Candidate:
    """A named, untrained classifier with its settings."""

    name: str
    params: Mapping[str, object]

    def estimator(self, label: str, size: Balance, seed: int):
        p = dict(self.params)
        if self.name == "logistic_regression":
            # Unit inverse penalty on summed losses equals 1/n on averaged losses when the
            # weights add up to n, which balanced weights do.
            return LogisticRegression(
                featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT,
                maxIter=int(p.get("max_iter", 1000)), regParam=1.0 / max(size.rows, 1),
                elasticNetParam=0.0, standardization=False,
            )
        if self.name == "random_forest":
            return RandomForestClassifier(
                featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, seed=seed,
                numTrees=int(p.get("n_estimators", 200)), maxDepth=int(p.get("max_depth", 10)),
                cacheNodeIds=True, checkpointInterval=10,
            )
        return GBTClassifier(
            featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, seed=seed,
            maxIter=int(p.get("n_estimators", 100)), maxDepth=int(p.get("max_depth", 5)),
            stepSize=float(p.get("learning_rate", 0.1)),
            subsamplingRate=float(p.get("subsample", 1.0)),
            # Columns are drawn per node; a share of 1 means all of them.
            featureSubsetStrategy=str(float(p.get("colsample_bytree", 1.0))),
            checkpointInterval=10,
        )

    def positive_weight(self) -> float | None:
        """Boosted models weigh positives; the others balance both classes."""
        return float(self.params.get("scale_pos_weight", 1.0)) if self.name in BOOSTED else None

    def fit(self, df: DataFrame, label: str = TARGET, seed: int = 42):
        size = balance(df, label)
        if size.rows == 0:
            raise ValueError("cannot train on an empty table")
        weighted = df.withColumn(WEIGHT, size.weight_column(label, self.positive_weight()))
        return self.estimator(label, size, seed).fit(weighted)


def base_models(config: TrainingConfig) -> dict[str, Candidate]:
    """The four candidates with their untuned settings."""
    return {
        "logistic_regression": Candidate(
            "logistic_regression", {"max_iter": config.logistic_iterations}
        ),
        "random_forest": Candidate(
            "random_forest", {"n_estimators": config.forest_trees, "max_depth": config.forest_depth}
        ),
        "xgboost": Candidate(
            "xgboost", {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3}
        ),
        "lightgbm": Candidate(
            "lightgbm", {"n_estimators": 100, "max_depth": 5, "learning_rate": 0.1}
        ),
    }


def configured_models(config: TrainingConfig) -> dict[str, Candidate]:
    """Candidates named in the configuration, in candidate order."""
    chosen = {n: c for n, c in base_models(config).items() if n in config.models}
    if not chosen:
        raise ValueError("no configured model is known; name at least one of the candidates")
    return chosen


def probability(model, df: DataFrame, out: str = "p") -> DataFrame:
    """Score of the positive class; works for fitted and for calibrated models."""
    if isinstance(model, CalibratedModel):
        return model.transform(df, out)
    helpers = ("rawPrediction", "probability", "prediction")
    scored = model.transform(df.drop(*helpers))
    return scored.withColumn(out, vector_to_array("probability")[1]).drop(*helpers)


def decision_value(model, df: DataFrame, out: str) -> DataFrame:
    """What calibration is fitted on: the log-odds of a linear model, else the probability."""
    if not isinstance(model, LogisticRegressionModel):
        return probability(model, df, out)
    helpers = ("rawPrediction", "probability", "prediction")
    scored = model.transform(df.drop(*helpers))
    return scored.withColumn(out, vector_to_array("rawPrediction")[1]).drop(*helpers)


# ---- out of fold ------------------------------------------------------------

Fitter = Callable[[DataFrame], object]


def out_of_fold(
    df: DataFrame, fit: Fitter, key: str, label: str = TARGET, folds: int = 5, seed: int = 42,
    keep: Iterable[str] = (),
) -> DataFrame:
    """``(key, fold, y, p, keep...)``: every row scored by the model that did not see it.

    ``df`` is read once per fit, so it should be a stored table. A ``fold`` column it already has
    is used, so the folds of several candidates are located once.
    """
    assigned = df if "fold" in df.columns else splits.assign_folds(df, key, label, folds, seed)
    parts = []
    for fold in range(folds):
        model = fit(assigned.filter(F.col("fold") != fold).drop("fold"))
        held = probability(model, assigned.filter(F.col("fold") == fold))
        parts.append(held.select(key, "fold", F.col(label).cast("int").alias("y"), "p", *keep))
    return settle(splits.concat(parts))


def cross_validated_pr_auc(
    df: DataFrame, fit: Fitter, key: str, label: str = TARGET, folds: int = 5, seed: int = 42
) -> float:
    """Average precision of the pooled out-of-fold scores."""
    pooled = out_of_fold(df, fit, key, label, folds, seed)
    return float(scores.average_precision(pooled).first()["pr_auc"])


def cross_validated_threshold(
    df: DataFrame, fit: Fitter, key: str, min_recall: float, label: str = TARGET, folds: int = 5,
    seed: int = 42,
) -> float:
    """Best cut on the pooled out-of-fold scores."""
    pooled = out_of_fold(df, fit, key, label, folds, seed)
    return float(scores.find_optimal_threshold(pooled, min_recall).first()["threshold"])


def fold_metrics(pooled: DataFrame) -> DataFrame:
    """ROC-AUC and PR-AUC of every fold, from the pooled scores in one pass."""
    return scores.compute_metrics(pooled, group=["fold"]).select("fold", "roc_auc", "pr_auc")


# ---- tuning -----------------------------------------------------------------

# ---- fixed values: bounds of the search space --------------------------------
SUBSAMPLE_RANGE = (0.6, 1.0)
COLSAMPLE_RANGE = (0.6, 1.0)
POSITIVE_WEIGHT_RANGE = (5.0, 15.0)
LEARNING_RATE_RANGE = (0.01, 0.3)
# ---- end of fixed values -----------------------------------------------------


def sample_params(config: TrainingConfig, rng: random.Random) -> dict[str, object]:
    """One random point of the search space; the learning rate is drawn log-uniformly."""
    low, high = (math.log(v) for v in LEARNING_RATE_RANGE)
    return {
        "n_estimators": rng.randint(*config.boosted_tree_range),
        "max_depth": rng.randint(*config.boosted_depth_range),
        "learning_rate": math.exp(rng.uniform(low, high)),
        "subsample": rng.uniform(*SUBSAMPLE_RANGE),
        "colsample_bytree": rng.uniform(*COLSAMPLE_RANGE),
        "scale_pos_weight": rng.uniform(*POSITIVE_WEIGHT_RANGE),
    }


def tune(
    name: str, train: DataFrame, val: DataFrame, config: TrainingConfig, label: str = TARGET
) -> tuple[Candidate, DataFrame]:
    """Seeded random search for the best validation PR-AUC.

    Trials are whole distributed fits; a small pool keeps the cluster busy between the
    short jobs of one fit. Returns the best candidate and a table of all trials.
    """
    rng = random.Random(f"{config.random_state}:{name}")
    points = [sample_params(config, rng) for _ in range(config.n_trials)]

    def run(params: dict[str, object]) -> float:
        model = Candidate(name, params).fit(train, label, config.random_state)
        scored = probability(model, val).select(F.col(label).alias("y"), "p")
        return float(scores.average_precision(scored).first()["pr_auc"])

    with ThreadPoolExecutor(max(1, config.parallel_trials)) as pool:
        results = list(pool.map(inheritable_thread_target(train.sparkSession)(run), points))
    best = max(range(len(points)), key=lambda i: (results[i], -i))
    rows = [(name, i, k, float(v)) for i, p in enumerate(points) for k, v in p.items()]
    rows += [(name, i, "pr_auc", results[i]) for i in range(len(points))]
    trials = train.sparkSession.createDataFrame(
        rows, "model string, trial int, name string, value double"
    )
    return Candidate(name, points[best]), trials


# ---- calibration ------------------------------------------------------------


@dataclass(frozen=True)
class Sigmoid:
    """Logistic map of a decision value."""

    slope: float
    intercept: float

    def apply(self, value: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.slope) * value + F.lit(self.intercept))))


@dataclass(frozen=True)
class CalibratedModel:
    """Average of fold models, each behind its own sigmoid."""

    members: tuple[tuple[object, Sigmoid], ...]

    def transform(self, df: DataFrame, out: str = "p") -> DataFrame:
        names = [f"_member_{i}" for i in range(len(self.members))]
        for name, (model, sigmoid) in zip(names, self.members):
            df = decision_value(model, df, name).withColumn(name, sigmoid.apply(F.col(name)))
        mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)
        return df.withColumn(out, mean).drop(*names)


def fit_sigmoid(scored: DataFrame, value: str, label: str = TARGET) -> Sigmoid:
    """Sigmoid of a decision value with smoothed targets.

    Rows are first reduced to distinct values. Each becomes a weighted positive and a
    weighted negative, with the targets pulled in by the class sizes.
    """
    by_value = settle(scores.score_counts(scored, label, value))
    totals = by_value.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    high = (totals["p"] + 1) / (totals["p"] + 2)
    low = 1 / (totals["n"] + 2)
    up = F.col("pos") * high + F.col("neg") * low
    pairs = F.array(
        F.struct(F.lit(1).alias("label"), up.alias("w")),
        F.struct(F.lit(0).alias("label"), (F.col("pos") + F.col("neg") - up).alias("w")),
    )
    rows = by_value.select("p", F.inline(pairs)).filter("w > 0")
    rows = rows.select(F.col("label").cast("double"), "w", _one_slot("p").alias("x"))
    model = LogisticRegression(
        featuresCol="x", labelCol="label", weightCol="w", regParam=0.0, maxIter=200
    ).fit(rows)
    return Sigmoid(float(model.coefficients[0]), float(model.intercept))


def _one_slot(column: str) -> Column:
    return array_to_vector(F.array(F.col(column).cast("double")))


def fit_calibrated(
    df: DataFrame, candidate: Candidate, key: str, label: str = TARGET, folds: int = 3, seed: int = 42
) -> CalibratedModel:
    """Fit on all folds but one, calibrate on that one, for every fold."""
    assigned = splits.assign_folds(df, key, label, folds, seed, "_calibration")
    members = []
    for fold in range(folds):
        model = candidate.fit(assigned.filter(F.col("_calibration") != fold), label, seed)
        held = decision_value(model, assigned.filter(F.col("_calibration") == fold), "_value")
        members.append((model, fit_sigmoid(held, "_value", label)))
    return CalibratedModel(tuple(members))
