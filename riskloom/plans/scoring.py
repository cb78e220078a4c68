"""Scoring of tables with stored artifacts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions.scoring import decision, risk_tier, round_score
from riskloom.operators import attribution, drift
from riskloom.operators.cleaning import fill_contract
from riskloom.operators.encoding import feature_names
from riskloom.plans import models
from riskloom.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from riskloom.session import stored
from riskloom.sources import artifacts
from riskloom.sources.checks import by_errors, require_rows, split_valid
from riskloom.sources.tables import load_records, parse_records, records_to_json

RESULT_COLUMNS = ("risk_score", "risk_tier", "readmitted", "top_reasons", "model_version")


@dataclass
class Scorer:
    """Encoder, scoring model, explanation model and cut of one training run."""

    encoder: PipelineModel
    model: object
    margin_model: object
    threshold: float
    model_version: str
    background: list[float] = field(default_factory=list)
    report: dict = field(default_factory=dict)
    _forest: object = None

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> "Scorer":
        """Load a stored run; fails at once when a part is missing."""
        if not artifacts.artifacts_ready(spark, root):
            raise FileNotFoundError(f"no complete model artifacts under {root}")
        paths = artifacts.current_run(spark, root)
        report = artifacts.load_metrics_report(spark, paths.report) or {}
        return cls(
            encoder=artifacts.load_encoder(paths.encoder),
            model=artifacts.load_model(paths.model, spark),
            margin_model=artifacts.load_model(paths.margin, spark),
            threshold=artifacts.load_threshold(spark, paths.threshold),
            model_version=report.get("model_version", "unknown"),
            background=list(report.get("background", [])),
            report=report,
        )

    @property
    def names(self) -> list[str]:
        return feature_names(self.encoder)

    def explain(self, encoded: DataFrame) -> DataFrame:
        """Adds ``contributions`` of the uncalibrated model to encoded rows."""
        if isinstance(self.margin_model, LogisticRegressionModel):
            coefficients = self.margin_model.coefficients.toArray().tolist()
            return attribution.linear_contributions(
                encoded, vector_to_array("features"), coefficients, self.background
            )
        if self._forest is None:
            self._forest = attribution.read_forest(encoded, self.margin_model)
        return attribution.tree_contributions(encoded, self._forest)

    def score(
        self, df: DataFrame, keep: Iterable[str] = (), explain: bool = True, top_n: int = 3
    ) -> DataFrame:
        """Score, tier, decision, reasons and version for every row of ``df``.

        One lazy plan without a shuffle: contract columns, encoder, model, expressions.
        """
        keep = list(keep)
        stashed = df.withColumns({f"_keep_{c}": F.col(c) for c in keep})
        rows = fill_contract(
            stashed, NUMERIC_FEATURES, CATEGORICAL_FEATURES, [f"_keep_{c}" for c in keep]
        )
        encoded = self.encoder.transform(rows).select(*[f"_keep_{c}" for c in keep], "features")
        scored = models.probability(self.model, encoded)
        reasons = F.lit(None).cast(attribution.REASON_TYPE)
        if explain:
            scored = self.explain(scored)
            reasons = attribution.top_reasons(self.names, top_n=top_n)
        # The tier and the decision use the unrounded score.
        return scored.select(
            *[F.col(f"_keep_{c}").alias(c) for c in keep],
            round_score(F.col("p")).alias("risk_score"),
            risk_tier(F.col("p")).alias("risk_tier"),
            decision(F.col("p"), self.threshold).alias("readmitted"),
            reasons.alias("top_reasons"),
            F.lit(self.model_version).alias("model_version"),
        )

    def predict(self, spark: SparkSession, record: Mapping[str, object]) -> dict:
        """Score one record given as a mapping; absent fields take the contract's fill."""
        known = [f for f in (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES) if f in record]
        schema = ", ".join(f"`{f}` {'double' if f in NUMERIC_FEATURES else 'string'}" for f in known)
        row = tuple(
            None if record[f] is None else float(record[f]) if f in NUMERIC_FEATURES else str(record[f])
            for f in known
        )
        result = self.score(spark.createDataFrame([row], schema)).first().asDict(recursive=True)
        return result

    def predict_batch(self, df: DataFrame, keep: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
        """Scores of the valid rows, and the quarantined rows with their errors."""
        valid, bad = split_valid(require_rows(df))
        return self.score(valid, keep), bad

    def predict_records(
        self, spark: SparkSession, records: Iterable[Mapping]
    ) -> tuple[DataFrame, DataFrame]:
        """Scores of in-memory records, and the rejected ones with their errors."""
        parsed = stored(parse_records(records_to_json(spark, records), "value"), "records")
        valid, bad = by_errors(require_rows(parsed))
        return self.score(valid), bad

    def predict_record_files(
        self, spark: SparkSession, path: str, keep: Mapping[str, str] | None = None
    ) -> tuple[DataFrame, DataFrame]:
        """Scores of JSON-lines records, and the rejected ones with their errors.

        ``keep`` names fields, with their types, that both results carry. Records are parsed
        once: the checked rows are stored, and both results read them.
        """
        valid, bad = by_errors(stored(load_records(spark, path, keep), "records"))
        return self.score(valid, list(keep or {})), bad

    def model_card(self, spark: SparkSession) -> DataFrame:
        """One row: type, version, cut, feature names, metrics, gate violations."""
        kind = type(self.model).__name__
        metrics = {k: float(v) for k, v in self.report.get("metrics", {}).items() if v is not None}
        return spark.createDataFrame(
            [
                (
                    kind, self.model_version, float(self.threshold), len(self.names), self.names,
                    metrics, list(self.report.get("quality_gate_violations", [])),
                )
            ],
            "model_type string, model_version string, threshold double, n_features int, "
            "feature_names array<string>, training_metrics map<string,double>, "
            "quality_gate_violations array<string>",
        )


def check_drift(spark: SparkSession, root: str, current: DataFrame, features=None) -> DataFrame:
    """Per-feature drift of a table against the stored training rows."""
    run = artifacts.current_run(spark, root)
    if run is None:
        raise FileNotFoundError(f"no training run under {root}")
    reference = artifacts.load_reference(spark, run.reference)
    return drift.drift_check(reference, require_rows(current), features)
