"""Encounter records derived from the order tables, one row per order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.functions import sqltext
from riskloom.operators import cleaning, features
from riskloom.schema import AGE_BRACKETS, MEDICATIONS, NUMERIC_FEATURES, RAW_COLUMNS
from riskloom.sources.tables import null_markers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index: str, options) -> str:
    """``options[index]``, null past the end."""
    return f"get(array({sqltext.values(options)}), int({index}))"


def _medication(position: int, name: str) -> str:
    idle = 7 if name == "insulin" else 12
    doses = ["No"] * idle + ["Steady"] * (14 - idle) + ["Down", "Up"]
    return _pick(f"(k * {2 * position + 3} + c * {position + 1} + {position}) % 16", doses)


def _diagnosis(number: str) -> str:
    return (
        f"CASE WHEN {number} >= 1080 THEN NULL WHEN {number} >= 1060 THEN '?' "
        f"WHEN {number} >= 1030 THEN concat('V', {number} % 90) "
        f"WHEN {number} >= 1000 THEN concat('E', {number} % 1000) "
        f"WHEN {number} % 4 = 0 THEN concat({number}, '.5') ELSE string({number}) END"
    )


def raw_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw columns, with the markers a raw file would hold."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey k", "o_custkey c", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey c", "c_nationkey")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("k"))
        .agg(F.sum("l_quantity").cast("bigint").alias("qty"), (F.count(F.lit(1)) * 7).alias("items"))
    )
    base = orders.join(customers, "c").join(lines, "k", "left").selectExpr(
        "*",
        "IF(c % 5 < 3, 0L, k % 4) AS inpatient",
        "IF(k % 7 < 5, 0L, c % 5) AS emergency",
        "IF((k + c) % 9 < 6, 0L, c % 8) AS outpatient",
        "(k * 37 + c) % 1100 AS e1",
        "(k * 53 + c * 2) % 1100 AS e2",
        "(k * 71 + c * 3) % 1100 AS e3",
    )
    risk = "3 * inpatient + 2 * emergency + (7919 * k) % 23"
    races = ["Caucasian", "AfricanAmerican", "Hispanic", "Asian", "Other"]
    made = {
        "encounter_id": "k",
        "patient_nbr": "c * 8 + k % 8",
        "race": _pick("c_nationkey % 6", races),
        "gender": "IF(c % 2 = 0, 'Female', 'Male')",
        "age": f"IF(k % 89 = 0, 'unknown', {_pick('(7 * c + k) % 10', AGE_BRACKETS)})",
        "weight": "string(NULL)",
        "admission_type_id": "1 + k % 8",
        "discharge_disposition_id": "1 + c % 28",
        "admission_source_id": "1 + (3 * k + c) % 25",
        "time_in_hospital": "IF(k % 97 = 0, 0L, 1 + (5 * k + c) % 14)",
        "payer_code": "string(NULL)",
        "medical_specialty": "IF(k % 2 = 0, NULL, o_orderpriority)",
        "num_lab_procedures": "qty % 133",
        "num_procedures": "k % 7",
        "num_medications": "items % 82",
        "number_outpatient": "outpatient",
        "number_emergency": "emergency",
        "number_inpatient": "inpatient",
        "diag_1": _diagnosis("e1"),
        "diag_2": _diagnosis("e2"),
        "diag_3": _diagnosis("e3"),
        "number_diagnoses": "1 + (k + c) % 16",
        "max_glu_serum": "'None'",
        "A1Cresult": _pick("(k + c) % 10", [">7", ">8", "Norm"] + ["None"] * 7),
        **{m: _medication(j, m) for j, m in enumerate(MEDICATIONS)},
        "change": "IF(k % 3 = 0, 'No', 'Ch')",
        "diabetesMed": "IF(k % 4 = 0, 'No', 'Yes')",
        "readmitted": f"CASE WHEN {risk} >= 22 THEN '<30' WHEN {risk} >= 17 THEN '>30' ELSE 'NO' END",
    }
    return base.selectExpr(*[f"{made[c]} AS {sqltext.name(c)}" for c in RAW_COLUMNS])


MARKED_COLUMNS = ("diag_1", "diag_2", "diag_3", "A1Cresult", "max_glu_serum")


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw encounters as a scan delivers them: markers are null."""
    return features.add_columns(
        raw_encounters(spark, sf_dir), {c: null_markers(c) for c in MARKED_COLUMNS}
    )


def scored_from(encounters: DataFrame) -> DataFrame:
    """Closed-form scores: ``encounter_id, y, p`` and the group columns."""
    margin = (
        "-3.0D + 0.45D * number_inpatient + 0.3D * number_emergency "
        "+ 0.04D * time_in_hospital + 0.01D * (encounter_id % 11)"
    )
    return features.engineer_age_ordinal(encounters).selectExpr(
        "encounter_id",
        "int(readmitted <=> '<30') AS y",
        f"round(1 / (1 + exp(-({margin}))), 6) AS p",
        "gender",
        "race",
        "age_ordinal",
        "admission_type_id",
    )


def two_scores_from(encounters: DataFrame) -> DataFrame:
    """Scores of two closed-form models: ``encounter_id, y, first, second``."""
    return encounters.selectExpr(
        "encounter_id",
        "int(readmitted <=> '<30') AS y",
        "round(1 / (1 + exp(-(-3.0D + 0.45D * number_inpatient + 0.3D * number_emergency))), 6) AS first",
        "round(1 / (1 + exp(-(-1.0D + 0.5D * number_inpatient + 0.02D * time_in_hospital))), 6) AS second",
    )


def numeric_rows(encounters: DataFrame) -> DataFrame:
    """Key and numeric features of every encounter."""
    e = cleaning.clean_data(features.run_feature_engineering(encounters), keep=["encounter_id"])
    return e.select("encounter_id", *NUMERIC_FEATURES)


def sides_of(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reference and current rows; the stay of the current side is two days longer."""
    current = F.col("encounter_id") % 3 == 0
    return (
        e.filter(~current),
        e.filter(current).withColumn("time_in_hospital", F.col("time_in_hospital") + 2),
    )
