"""Scoring and drift of arriving records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators import drift
from riskloom.operators.counts import ranged_counts
from riskloom.plans.scoring import Scorer
from riskloom.schema import contract_schema
from riskloom.sources.checks import split_valid


def read_requests(spark: SparkSession, path: str, schema=None, files_per_batch: int = 1000) -> DataFrame:
    """Parquet folder of score requests as a stream."""
    return (
        spark.readStream.schema(schema or contract_schema())
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def score_stream(
    scorer: Scorer, requests: DataFrame, out: str, checkpoint: str | None = None,
    keep: Iterable[str] = (), rejected: str | None = None,
) -> StreamingQuery:
    """Append the scores of valid requests to a parquet folder until the input is used up.

    Invalid requests go to ``rejected`` (by default ``<out>-rejected``) with their errors.
    Every batch is the batch scoring plan and has a folder of its own in both places, so a
    batch that is run again replaces what it wrote. Batches are numbered by the checkpoint, which
    belongs to ``out`` (``<out>-checkpoint``): a later run into the same folder goes on with the
    next number and reads only requests that have arrived since.
    """
    checkpoint = checkpoint or f"{out.rstrip('/')}-checkpoint"
    rejected = rejected or f"{out.rstrip('/')}-rejected"

    def write(batch: DataFrame, number: int) -> None:
        valid, bad = split_valid(batch)
        scorer.score(valid, keep).write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")
        bad.write.mode("overwrite").parquet(f"{rejected.rstrip('/')}/batch={number}")

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drift_stream(
    reference: DataFrame, current: DataFrame, out: str, features: Iterable[str] | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Drift report of every micro-batch, one folder per batch so that a retry replaces it.

    The checkpoint belongs to ``out``, as that of :func:`score_stream` does.
    """
    checkpoint = checkpoint or f"{out.rstrip('/')}-checkpoint"
    names = list(features) if features is not None else None
    # The reference is read once; every batch only counts its own rows.
    stored = drift.reference_counts(reference, names)

    def report(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            pairs = ranged_counts(drift.add_current(stored, batch, names))
            drift.drift_from_counts(pairs).write.mode("overwrite").parquet(
                f"{out.rstrip('/')}/batch={number}"
            )

    return (
        current.writeStream.foreachBatch(report)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
