"""What a training run leaves behind, and how it is read back.

Every run writes a folder of its own: the encoder, every fitted candidate, the scoring model (a single model or the
members of a calibrated one), the margin model used for explanations, the threshold record, the
reference snapshot for drift, the run table, the evaluation tables and the report. When all of
it is there, one record is added to ``pointers`` of the artifact folder, and readers follow the
newest record. A run that fails on the way leaves the earlier one in use.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.plans.models import CalibratedModel, Sigmoid

DEFAULT_THRESHOLD = 0.5
SINGLE, CALIBRATED = "single", "calibrated"


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def save_model(model, path: str, spark: SparkSession) -> None:
    """Save a fitted model with MLlib's own writer; a calibrated one member by member.

    A record beside it names the form, so what an earlier model left in the folder is not read.
    """
    if isinstance(model, CalibratedModel):
        rows = []
        for i, (member, sigmoid) in enumerate(model.members):
            member.write().overwrite().save(f"{path}/member-{i}")
            rows.append((i, sigmoid.slope, sigmoid.intercept))
        spark.createDataFrame(rows, "member int, slope double, intercept double").coalesce(
            1
        ).write.mode("overwrite").json(f"{path}/sigmoids")
    else:
        model.write().overwrite().save(f"{path}/single")
    form = (CALIBRATED if isinstance(model, CalibratedModel) else SINGLE,)
    spark.createDataFrame([form], "form string").coalesce(1).write.mode("overwrite").text(f"{path}/form")


def load_model(path: str, spark: SparkSession):
    """Reload whatever ``save_model`` stored."""
    if spark.read.text(f"{path}/form").first()[0] == SINGLE:
        return _load_any(f"{path}/single", spark)
    rows = spark.read.schema("member int, slope double, intercept double").json(f"{path}/sigmoids")
    members = [
        (_load_any(f"{path}/member-{r['member']}", spark), Sigmoid(r["slope"], r["intercept"]))
        for r in sorted(rows.collect())
    ]
    return CalibratedModel(tuple(members))


def _load_any(path: str, spark: SparkSession):
    return DefaultParamsReader.loadParamsInstance(path, spark)


def save_threshold(
    spark: SparkSession, path: str, threshold: float, min_recall: float, fingerprint: str
) -> None:
    row = [(float(threshold), float(min_recall), fingerprint)]
    spark.createDataFrame(
        row, "threshold double, min_recall double, training_fingerprint string"
    ).coalesce(1).write.mode("overwrite").json(path)


def load_threshold(spark: SparkSession, path: str) -> float:
    """Stored cut; 0.5 when the file is absent, unreadable or holds no number."""
    try:
        table = spark.read.schema("threshold string").json(path)
        row = table.select(F.col("threshold").try_cast("double").alias("t")).first()
    except AnalysisException:
        return DEFAULT_THRESHOLD
    return DEFAULT_THRESHOLD if row is None or row["t"] is None else float(row["t"])


def report_table(
    spark: SparkSession, metrics: Mapping[str, float], threshold: float,
    extra: Mapping[str, object] | None = None,
) -> DataFrame:
    """One row whose ``report`` is JSON with sorted keys: cut, metrics and extras."""
    body = {
        "threshold": float(threshold),
        "metrics": {k: None if v is None else float(v) for k, v in metrics.items()},
        **(extra or {}),
    }
    return spark.createDataFrame([(json.dumps(body, sort_keys=True),)], "report string")


def save_metrics_report(
    spark: SparkSession, path: str, metrics: Mapping[str, float], threshold: float,
    extra: Mapping[str, object] | None = None,
) -> str:
    """Write the report as one JSON line."""
    report_table(spark, metrics, threshold, extra).coalesce(1).write.mode("overwrite").text(path)
    return path


def load_metrics_report(spark: SparkSession, path: str) -> dict | None:
    if not _exists(spark, path):
        return None
    row = spark.read.text(path).first()
    return json.loads(row[0]) if row else None


def save_reference(df: DataFrame, features: Iterable[str], path: str) -> None:
    """Raw numeric features of the training rows, for later drift checks."""
    df.select(*features).write.mode("overwrite").parquet(path)


def load_reference(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, path):
        raise FileNotFoundError(f"no reference snapshot at {path}; run training first")
    return spark.read.parquet(path)


@dataclass(frozen=True)
class ArtifactPaths:
    """Layout of the folder of one run."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name not in (
            "encoder", "model", "margin", "threshold", "reference", "runs", "report", "evaluation", "importance",
        ):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"

    def candidate(self, name: str) -> str:
        """Where a fitted candidate is kept, chosen or not."""
        return f"{self.root.rstrip('/')}/candidates/{name}"


def new_run(root: str) -> ArtifactPaths:
    """A fresh folder for one run."""
    return ArtifactPaths(f"{root.rstrip('/')}/run-{uuid.uuid4().hex}")


def publish_run(spark: SparkSession, root: str, run: ArtifactPaths) -> None:
    """Make a complete run the one that readers use: one appended record."""
    row = [(run.root.rsplit("/", 1)[-1], time.time_ns())]
    spark.createDataFrame(row, "run string, written long").coalesce(1).write.mode("append").json(
        f"{root.rstrip('/')}/pointers"
    )


def current_run(spark: SparkSession, root: str) -> ArtifactPaths | None:
    """The run that was published last; None where none was."""
    pointers = f"{root.rstrip('/')}/pointers"
    if not _exists(spark, pointers):
        return None
    rows = spark.read.schema("run string, written long").json(pointers)
    row = rows.filter("run IS NOT NULL").agg(F.max_by("run", "written").alias("run")).first()
    return None if row["run"] is None else ArtifactPaths(f"{root.rstrip('/')}/{row['run']}")


def artifacts_ready(spark: SparkSession, root: str) -> bool:
    """Whether a scorer can be loaded from the folder: it needs an encoder and a model."""
    paths = current_run(spark, root)
    return paths is not None and all(_exists(spark, p) for p in (paths.encoder, paths.model))


def load_encoder(path: str) -> PipelineModel:
    return PipelineModel.load(path)
