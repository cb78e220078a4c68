"""Join forms of the lookups, for dimensions that live in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions import sqltext
from riskloom.functions.codes import code_number, group_pairs
from riskloom.schema import ICD_RANGES, ICD_WHOLE_CODES


def lookup_join(
    df: DataFrame, dim: DataFrame, key: str, value: str, out: str, default: str
) -> DataFrame:
    """Left join ``dim(code, value)`` on ``df[key]``, unmatched rows get ``default``."""
    # The optimizer broadcasts a dimension that it knows to be small.
    side = dim.select(F.col("code").alias("_code"), F.col(value).alias("_value"))
    return (
        df.join(side, F.col(key) == F.col("_code"), "left")
        .withColumn(out, F.coalesce(F.col("_value"), F.lit(default)))
        .drop("_code", "_value")
    )


def code_group_dim(spark: SparkSession, groups) -> DataFrame:
    """``(code, grp)`` rows of a fixed code table."""
    return spark.createDataFrame(group_pairs(groups), "code bigint, grp string")


def icd_code_dim(spark: SparkSession) -> DataFrame:
    """ICD intervals unrolled to one row per integer code.

    Turns the range lookup into an equi-join; ``whole_only`` marks codes that match
    only without a fraction.
    """
    ranges = spark.createDataFrame(ICD_RANGES, "low int, high int, grp string").select(
        F.explode(F.sequence(F.col("low").cast("bigint"), F.col("high").cast("bigint"))).alias("code"),
        "grp",
        F.lit(False).alias("whole_only"),
    )
    singles = spark.createDataFrame(ICD_WHOLE_CODES, "code bigint, grp string").withColumn(
        "whole_only", F.lit(True)
    )
    return ranges.unionByName(singles)


def icd_category_join(df: DataFrame, code: str, out: str) -> DataFrame:
    """Second form of the ICD grouping: an equi-join on the integer part.

    The dimension is fixed at under 1,000 rows, so it is always broadcast.
    """
    dim = icd_code_dim(df.sparkSession).withColumnRenamed("code", "_code")
    number = F.expr(code_number(sqltext.name(code)))
    keyed = df.withColumn("_number", number).withColumn(
        "_whole", F.when(F.abs("_number") < 1e6, F.col("_number").cast("bigint"))
    )
    matched = keyed.join(
        F.broadcast(dim),
        (F.col("_whole") == F.col("_code"))
        & (~F.col("whole_only") | (F.col("_number") == F.col("_whole"))),
        "left",
    )
    prefixed = F.upper(F.substring(F.trim(F.col(code)), 1, 1)).isin("V", "E")
    return matched.withColumn(
        out, F.when(prefixed, "External").otherwise(F.coalesce(F.col("grp"), F.lit("Other")))
    ).drop("_number", "_whole", "_code", "whole_only", "grp")
