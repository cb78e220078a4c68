"""Feature steps on raw encounters.

Every step is a narrow projection, so the chain runs in one pass over the scan without
a shuffle. Columns absent from the input are replaced by constants when the plan is
built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.functions import codes, sqltext
from riskloom.schema import (
    ADMISSION_SOURCE_GROUPS,
    DISCHARGE_GROUPS,
    DOSE_ACTIVE,
    DOSE_CHANGED,
    MEDICATIONS,
)

HIGH_UTILIZER_VISITS = 5
VISIT_COLUMNS = ("number_inpatient", "number_outpatient", "number_emergency")


def add_columns(df: DataFrame, made: dict[str, str]) -> DataFrame:
    """``withColumns`` over SQL text."""
    return df.withColumns({name: F.expr(text) for name, text in made.items()}) if made else df


def engineer_diagnosis_features(df: DataFrame) -> DataFrame:
    """``diag_1..3`` to ``diag1_category..diag3_category``."""
    present = [i for i in (1, 2, 3) if f"diag_{i}" in df.columns]
    parsed = add_columns(df, {f"_icd_{i}": codes.code_number(f"diag_{i}") for i in present})
    made = {
        f"diag{i}_category": codes.icd9_category(f"diag_{i}", f"_icd_{i}") if i in present else "'Other'"
        for i in (1, 2, 3)
    }
    dropped = [f"{prefix}_{i}" for prefix in ("diag", "_icd") for i in (1, 2, 3)]
    return add_columns(parsed, made).drop(*dropped)


def engineer_medication_features(df: DataFrame) -> DataFrame:
    """Counts of changed and active medications, insulin flag; drops the inputs."""
    present = [m for m in MEDICATIONS if m in df.columns]

    def count(doses: tuple[str, ...]) -> str:
        flags = [
            sqltext.flag(f"{sqltext.name(m)} IN ({sqltext.values(doses)})") for m in present
        ]
        return " + ".join(flags) or "0"

    changed = sqltext.flag(f"insulin IN ({sqltext.values(DOSE_CHANGED)})")
    return add_columns(
        df,
        {
            "num_med_changes": count(DOSE_CHANGED),
            "num_meds_active": count(DOSE_ACTIVE),
            "insulin_changed": changed if "insulin" in present else "0",
        },
    ).drop(*present)


def engineer_visit_decomposition(df: DataFrame) -> DataFrame:
    """Keep the three visit counts under their model names."""
    kinds = ("emergency", "inpatient", "outpatient")
    return add_columns(
        df,
        {f"num_{k}_visits": f"number_{k}" if f"number_{k}" in df.columns else "0" for k in kinds},
    )


def engineer_utilization_features(
    df: DataFrame, threshold: int = HIGH_UTILIZER_VISITS
) -> DataFrame:
    """Total prior visits and the frequent-visitor flag; absent counts become 0."""
    total = " + ".join(VISIT_COLUMNS)
    return add_columns(
        add_columns(df, {c: "0" for c in VISIT_COLUMNS if c not in df.columns}),
        {
            "total_prior_visits": total,
            "high_utilizer": sqltext.flag(f"{total} >= {int(threshold)}"),
        },
    )


def engineer_age_ordinal(df: DataFrame) -> DataFrame:
    """Age bracket text to its position."""
    if "age" not in df.columns:
        return add_columns(df, {"age_ordinal": "-1"})
    return add_columns(df, {"age_ordinal": codes.age_ordinal("age")}).drop("age")


def engineer_intensity_features(df: DataFrame) -> DataFrame:
    """Per-day ratios over at least one day, and the share of changed medications."""
    # greatest() skips nulls, so a missing stay is kept missing explicitly.
    days = "IF(time_in_hospital IS NULL, NULL, greatest(time_in_hospital, 1))"
    days = days if "time_in_hospital" in df.columns else "1"
    numerators = {
        "lab_procedure_intensity": "num_lab_procedures",
        "procedure_intensity": "num_procedures",
        "medication_intensity": "num_medications",
        "diagnosis_complexity": "number_diagnoses",
    }
    made = {
        out: f"double({source}) / {days}" if source in df.columns else "0.0D"
        for out, source in numerators.items()
    }
    changes, active = (
        c if c in df.columns else "0" for c in ("num_med_changes", "num_meds_active")
    )
    made["med_change_ratio"] = f"try_divide(double({changes}), {active} + 1)"
    return add_columns(df, made)


def engineer_clinical_flags(df: DataFrame) -> DataFrame:
    """A1C, diabetes-medication and medication-change flags; drops the inputs."""
    sources = {
        "A1Cresult_abnormal": ("A1Cresult", (">7", ">8")),
        "diabetesMed_flag": ("diabetesMed", ("Yes",)),
        "change_flag": ("change", ("Ch",)),
    }
    made = {
        out: sqltext.flag(f"{sqltext.name(source)} IN ({sqltext.values(hits)})")
        if source in df.columns
        else "0"
        for out, (source, hits) in sources.items()
    }
    return add_columns(df, made).drop(*(source for source, _ in sources.values()))


def engineer_disposition_features(df: DataFrame) -> DataFrame:
    """Group discharge and admission-source codes; drops the inputs."""
    tables = {
        "discharge_disposition": DISCHARGE_GROUPS,
        "admission_source": ADMISSION_SOURCE_GROUPS,
    }
    made = {
        f"{name}_grouped": codes.code_group(f"{name}_id", groups)
        if f"{name}_id" in df.columns
        else "'Other'"
        for name, groups in tables.items()
    }
    return add_columns(df, made).drop(*(f"{name}_id" for name in tables))


FEATURE_STEPS = (
    engineer_diagnosis_features,
    engineer_medication_features,
    engineer_visit_decomposition,
    engineer_utilization_features,
    engineer_age_ordinal,
    engineer_intensity_features,
    engineer_clinical_flags,
    engineer_disposition_features,
)


def run_feature_engineering(df: DataFrame) -> DataFrame:
    """The full chain, in the order the steps depend on each other."""
    for step in FEATURE_STEPS:
        df = df.transform(step)
    return df
