"""Column names, fixed lookup values and the score-request contract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---- fixed values ---------------------------------------------------------
# Texts a scan reads as missing: the question mark plus the default markers of
# the usual data-frame CSV readers.
MISSING_MARKERS = (
    "?", "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

MEDICATIONS = (
    "metformin", "repaglinide", "nateglinide", "chlorpropamide",
    "glimepiride", "acetohexamide", "glipizide", "glyburide",
    "tolbutamide", "pioglitazone", "rosiglitazone", "acarbose",
    "miglitol", "troglitazone", "tolazamide", "examide",
    "citoglipton", "insulin", "glyburide-metformin",
    "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone",
)
DOSE_CHANGED = ("Up", "Down")
DOSE_ACTIVE = ("Up", "Down", "Steady")

AGE_BRACKETS = (
    "[0-10)", "[10-20)", "[20-30)", "[30-40)", "[40-50)",
    "[50-60)", "[60-70)", "[70-80)", "[80-90)", "[90-100)",
)

# ICD-9: whole codes with their own group, then inclusive integer ranges.
ICD_WHOLE_CODES = (
    (785, "Circulatory"),
    (786, "Respiratory"),
    (787, "Digestive"),
    (788, "Genitourinary"),
)
ICD_RANGES = (
    (249, 259, "Diabetes"),
    (390, 459, "Circulatory"),
    (460, 519, "Respiratory"),
    (520, 579, "Digestive"),
    (580, 629, "Genitourinary"),
    (710, 739, "Musculoskeletal"),
    (800, 999, "Injury"),
    (140, 239, "Neoplasms"),
)

DISCHARGE_GROUPS = (
    ("Home", (1,)),
    ("Transfer", (2, 3, 4, 5)),
    ("Home_Health", (6, 8)),
    ("AMA_Left", (7, 9, 10, 12)),
    ("SNF_Rehab", (11, 13, 14, 15, 22, 23, 24)),
)
ADMISSION_SOURCE_GROUPS = (
    ("Referral", (1, 2, 3)),
    ("Transfer", (4, 5, 6, 10, 22)),
    ("Emergency", (7,)),
    ("Court_Law", (8,)),
)

REQUIRED_COLUMNS = (
    "encounter_id", "patient_nbr", "race", "gender", "age",
    "admission_type_id", "time_in_hospital", "num_lab_procedures",
    "num_procedures", "num_medications", "number_outpatient",
    "number_emergency", "number_inpatient", "number_diagnoses",
    "diag_1", "diag_2", "diag_3", "insulin", "readmitted",
)

NUMERIC_FEATURES = (
    "age_ordinal", "time_in_hospital", "num_lab_procedures",
    "num_procedures", "num_medications", "number_diagnoses",
    "num_med_changes", "num_meds_active", "total_prior_visits",
    "insulin_changed", "high_utilizer", "medical_specialty_missing",
    "num_emergency_visits", "num_inpatient_visits", "num_outpatient_visits",
    "lab_procedure_intensity", "procedure_intensity", "medication_intensity",
    "diagnosis_complexity", "med_change_ratio", "A1Cresult_abnormal",
    "diabetesMed_flag", "change_flag",
)
CATEGORICAL_FEATURES = (
    "race", "gender", "diag1_category", "diag2_category", "diag3_category",
    "admission_type_id", "discharge_disposition_grouped",
    "admission_source_grouped",
)

FAIRNESS_COLUMNS = ("gender", "race", "age_ordinal", "admission_type_id")
RISK_TIERS = ("Low", "Medium", "High")
# ---- end of fixed values ---------------------------------------------------

TARGET = "readmitted"

COUNT_COLUMNS = (
    "time_in_hospital", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "number_diagnoses",
)
ID_COLUMNS = (
    "encounter_id", "patient_nbr", "admission_type_id",
    "discharge_disposition_id", "admission_source_id",
)

# Column order of the raw encounter file.
RAW_COLUMNS = (
    "encounter_id", "patient_nbr", "race", "gender", "age", "weight",
    "admission_type_id", "discharge_disposition_id", "admission_source_id",
    "time_in_hospital", "payer_code", "medical_specialty",
    "num_lab_procedures", "num_procedures", "num_medications",
    "number_outpatient", "number_emergency", "number_inpatient",
    "diag_1", "diag_2", "diag_3", "number_diagnoses", "max_glu_serum",
    "A1Cresult", *MEDICATIONS, "change", "diabetesMed", "readmitted",
)


def raw_type(column: str) -> T.DataType:
    """Type of a raw encounter column after the scan."""
    if column in COUNT_COLUMNS or column in ID_COLUMNS:
        return T.LongType()
    return T.StringType()


@dataclass(frozen=True)
class FieldRule:
    """One field of a score request: type, bounds, and the value used when absent."""

    name: str
    kind: str  # "int", "double" or "string"
    low: float | None = None
    high: float | None = None
    default: object | None = None

    @property
    def required(self) -> bool:
        return self.default is None


# ---- fixed values: ranges and defaults of a score request -------------------
CONTRACT = (
    FieldRule("age_ordinal", "int", 0, 9),
    FieldRule("time_in_hospital", "int", 1, 14),
    FieldRule("num_lab_procedures", "int", 0, 132),
    FieldRule("num_procedures", "int", 0, 6, default=0),
    FieldRule("num_medications", "int", 0, 81),
    FieldRule("number_diagnoses", "int", 1, 16),
    FieldRule("num_med_changes", "int", 0, 23),
    FieldRule("num_meds_active", "int", 0, 23),
    FieldRule("total_prior_visits", "int", 0, 100),
    FieldRule("insulin_changed", "int", 0, 1),
    FieldRule("high_utilizer", "int", 0, 1, default=0),
    FieldRule("medical_specialty_missing", "int", 0, 1, default=1),
    FieldRule("num_emergency_visits", "int", 0, default=0),
    FieldRule("num_inpatient_visits", "int", 0, default=0),
    FieldRule("num_outpatient_visits", "int", 0, default=0),
    FieldRule("lab_procedure_intensity", "double", 0.0, default=0.0),
    FieldRule("procedure_intensity", "double", 0.0, default=0.0),
    FieldRule("medication_intensity", "double", 0.0, default=0.0),
    FieldRule("diagnosis_complexity", "double", 0.0, default=0.0),
    FieldRule("med_change_ratio", "double", 0.0, default=0.0),
    FieldRule("A1Cresult_abnormal", "int", 0, 1, default=0),
    FieldRule("diabetesMed_flag", "int", 0, 1, default=0),
    FieldRule("change_flag", "int", 0, 1, default=0),
    FieldRule("race", "string", default="Unknown"),
    FieldRule("gender", "string"),
    FieldRule("diag1_category", "string", default="Other"),
    FieldRule("diag2_category", "string", default="Other"),
    FieldRule("diag3_category", "string", default="Other"),
    FieldRule("admission_type_id", "string", default="1"),
    FieldRule("discharge_disposition_grouped", "string", default="Other"),
    FieldRule("admission_source_grouped", "string", default="Other"),
)
# ---- end of fixed values ---------------------------------------------------

_SPARK_KINDS = {"int": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def contract_schema() -> T.StructType:
    """Typed schema of one score request."""
    return T.StructType([T.StructField(r.name, _SPARK_KINDS[r.kind]) for r in CONTRACT])
