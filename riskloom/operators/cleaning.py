"""Cleaning, deduplication and column contracts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from riskloom.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET

DROPPED_COLUMNS = ("encounter_id", "patient_nbr", "weight", "payer_code")


def deduplicate_patients(
    df: DataFrame, patient: str = "patient_nbr", encounter: str = "encounter_id",
    ties: Iterable[str] = (),
) -> DataFrame:
    """First encounter of every patient.

    The rank filter becomes a per-task group limit ahead of the shuffle, so a patient
    with very many encounters sends at most one row per map task. Encounter ids are
    unique; where a source repeats them, ``ties`` names columns that settle the order.
    Only the columns used later are read and shuffled.
    """
    first = Window.partitionBy(patient).orderBy(F.col(encounter).asc_nulls_last(), *ties)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def drop_columns(df: DataFrame, names: Iterable[str] = DROPPED_COLUMNS) -> DataFrame:
    """Drop columns, ignoring the absent ones."""
    return df.drop(*names)


def clean_data(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop ids, flag missing specialties, make the 0/1 target, text admission types.

    ``keep`` names id columns a later step still needs (split keys, score keys).
    """
    kept = set(keep)
    if "medical_specialty" in df.columns:
        missing = F.col("medical_specialty").isNull().cast("int")
    else:
        missing = F.lit(1)
    made = {
        "medical_specialty_missing": missing,
        TARGET: F.col(TARGET).eqNullSafe("<30").cast("int"),
    }
    if "admission_type_id" in df.columns:
        made["admission_type_id"] = F.col("admission_type_id").cast("string")
    dropped = [c for c in DROPPED_COLUMNS if c not in kept]
    return drop_columns(df.withColumns(made), (*dropped, "medical_specialty"))


def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """Model columns present in ``df``: numeric, categorical."""
    return (
        [c for c in NUMERIC_FEATURES if c in df.columns],
        [c for c in CATEGORICAL_FEATURES if c in df.columns],
    )


def select_model_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Project to the model columns that exist, plus ``keep``."""
    numeric, categorical = feature_columns(df)
    return df.select(*keep, *numeric, *categorical)


def fill_contract(
    df: DataFrame,
    numeric: Iterable[str] = NUMERIC_FEATURES,
    categorical: Iterable[str] = CATEGORICAL_FEATURES,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Exactly the model columns: absent numerics 0, absent categories ``Other``.

    Nulls in columns that exist are left to the imputer.
    """
    have = set(df.columns)
    columns = [F.col(c) for c in keep]
    columns += [F.col(c) if c in have else F.lit(0).alias(c) for c in numeric]
    columns += [F.col(c) if c in have else F.lit("Other").alias(c) for c in categorical]
    return df.select(*columns)
