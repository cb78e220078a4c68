"""Shared-folder helpers: where long lineages are cut and artifacts are staged."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    A local session that names none (a unit test) gets a folder of its own; a
    cluster session must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/riskloom/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Run ``df`` once and continue from a columnar file of its rows."""
    return stored(df, "settled")


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the file.

    For wide tables that are read many times: later passes read only their columns, and a
    filter on ``partition_by`` reads only its folder. Column metadata is kept.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the wide feature projections profit from.

    The JIT compiler skips methods above 8,000 bytes of bytecode, so a generated method
    beyond that would run interpreted; below the limit Spark splits such a projection
    into compilable pieces instead.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
