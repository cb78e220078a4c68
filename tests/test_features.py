import pytest
from pyspark.sql import functions as F

from riskloom import schema
from riskloom.functions.codes import icd9_category
from riskloom.operators import cleaning, features
from riskloom.schema import AGE_BRACKETS, CATEGORICAL_FEATURES, MEDICATIONS, NUMERIC_FEATURES

ICD_CASES = {
    None: "Other", "": "Other", "   ": "Other", "?": "Other", "abc": "Other",
    "V45": "External", "E819": "External", "v10": "External", "e950": "External",
    "250": "Diabetes", "250.13": "Diabetes", "249.5": "Diabetes", "259.9": "Diabetes", "260": "Other",
    "390": "Circulatory", "459.9": "Circulatory", "785": "Circulatory", "785.5": "Other",
    "460": "Respiratory", "519": "Respiratory", "786": "Respiratory", "786.2": "Other",
    "520": "Digestive", "579": "Digestive", "787": "Digestive", "787.0": "Digestive",
    "580": "Genitourinary", "629": "Genitourinary", "788": "Genitourinary",
    "710": "Musculoskeletal", "739.1": "Musculoskeletal",
    "800": "Injury", "999": "Injury", "1000": "Other",
    "140": "Neoplasms", "239": "Neoplasms", "240": "Other", " 428 ": "Circulatory",
    "nan": "Other", "inf": "Other", "250d": "Other", "-250": "Other", "0": "Other", "2.5e2": "Diabetes",
}


def first(df):
    return df.first().asDict()


def test_icd_cases(spark):
    rows = spark.createDataFrame([(c,) for c in ICD_CASES], "code string")
    got = rows.select("code", F.expr(icd9_category("code")).alias("g")).collect()
    assert {r["code"]: r["g"] for r in got} == ICD_CASES


def test_icd_groups_follow_the_interval_table(spark):
    """Every whole code lies in the group whose interval of the fixed table holds it."""
    inside = {}
    for low, high, group in schema.ICD_RANGES:
        for code in range(low, high + 1):
            inside.setdefault(code, group)
    whole = dict(schema.ICD_WHOLE_CODES)
    codes = list(range(0, 1101))
    rows = spark.createDataFrame([(str(c), f"{c}.25") for c in codes], "code string, part string")
    got = rows.select("code", F.expr(icd9_category("code")).alias("g"), F.expr(icd9_category("part")).alias("p"))
    for r in got.collect():
        code = int(r["code"])
        assert r["p"] == inside.get(code, "Other"), code
        assert r["g"] == whole.get(code, inside.get(code, "Other")), code


def test_icd_texts_that_are_no_numbers(spark):
    rows = spark.createDataFrame([("x1",), ("..",), ("78 5",), (" ",)], "code string")
    assert {r[0] for r in rows.select(F.expr(icd9_category("code"))).collect()} == {"Other"}


def test_diagnosis_columns_present_and_absent(spark):
    row = first(features.engineer_diagnosis_features(spark.createDataFrame([("250", "V1")], "diag_1 string, diag_2 string")))
    assert row == {"diag1_category": "Diabetes", "diag2_category": "External", "diag3_category": "Other"}


def medication_row(spark, **doses):
    values = {m: doses.get(m, "No") for m in MEDICATIONS}
    schema = ", ".join(f"`{m}` string" for m in MEDICATIONS)
    return spark.createDataFrame([tuple(values.values())], schema)


def test_medication_counts(spark):
    df = medication_row(spark, acarbose="Steady", repaglinide="Steady", glimepiride="Down", insulin="Steady", nateglinide="Up")
    assert first(features.engineer_medication_features(df)) == {
        "num_med_changes": 2, "num_meds_active": 5, "insulin_changed": 0,
    }


def test_medication_nulls_and_absent_columns(spark):
    df = medication_row(spark, metformin=None)
    assert first(features.engineer_medication_features(df))["num_meds_active"] == 0
    none = first(features.engineer_medication_features(spark.range(1)))
    assert (none["num_med_changes"], none["num_meds_active"], none["insulin_changed"]) == (0, 0, 0)


@pytest.mark.parametrize("visits, total, flag", [((1, 2, 3), 6, 1), ((1, 1, 0), 2, 0), ((5, 0, 0), 5, 1), ((None, 9, 0), None, 0)])
def test_utilization(spark, visits, total, flag):
    df = spark.createDataFrame([visits], "number_inpatient bigint, number_outpatient bigint, number_emergency bigint")
    row = first(features.engineer_utilization_features(df))
    assert (row["total_prior_visits"], row["high_utilizer"]) == (total, flag)


def test_utilization_absent_columns_and_threshold(spark):
    df = spark.createDataFrame([(4,)], "number_inpatient bigint")
    row = first(features.engineer_utilization_features(df, threshold=4))
    assert (row["number_emergency"], row["total_prior_visits"], row["high_utilizer"]) == (0, 4, 1)


def test_visit_decomposition(spark):
    row = first(features.engineer_visit_decomposition(spark.createDataFrame([(3,)], "number_emergency bigint")))
    assert (row["num_emergency_visits"], row["num_inpatient_visits"]) == (3, 0)


def test_age_brackets(spark):
    ages = [*AGE_BRACKETS, "unknown", None]
    df = features.engineer_age_ordinal(spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i int, age string"))
    assert [r["age_ordinal"] for r in df.orderBy("i").collect()] == [*range(10), -1, -1]
    assert first(features.engineer_age_ordinal(spark.range(1)))["age_ordinal"] == -1


def intensity(spark, days, labs=63):
    schema = ("time_in_hospital bigint, num_lab_procedures bigint, num_procedures bigint, "
              "num_medications bigint, number_diagnoses bigint, num_med_changes int, num_meds_active int")
    return first(features.engineer_intensity_features(spark.createDataFrame([(days, labs, 2, 9, 5, 3, 5)], schema)))


def test_intensity(spark):
    row = intensity(spark, 5)
    got = [row[c] for c in ("lab_procedure_intensity", "procedure_intensity", "medication_intensity",
                            "diagnosis_complexity", "med_change_ratio")]
    assert got == [12.6, 0.4, 1.8, 1.0, 0.5]


def test_intensity_zero_and_missing_days(spark):
    assert intensity(spark, 0, 10)["lab_procedure_intensity"] == 10.0
    assert intensity(spark, None)["lab_procedure_intensity"] is None
    assert intensity(spark, 4, None)["lab_procedure_intensity"] is None


def test_intensity_absent_columns(spark):
    row = first(features.engineer_intensity_features(spark.createDataFrame([(10,)], "num_procedures bigint")))
    assert row["procedure_intensity"] == 10.0
    assert row["lab_procedure_intensity"] == 0.0 and row["med_change_ratio"] == 0.0


def test_clinical_flags(spark):
    rows = [(">7", "Yes", "Ch"), (">8", "No", "No"), ("Norm", "Yes", "Ch"), (None, None, None)]
    df = features.engineer_clinical_flags(spark.createDataFrame(rows, "A1Cresult string, diabetesMed string, change string"))
    assert [tuple(r) for r in df.collect()] == [(1, 1, 1), (1, 0, 0), (0, 1, 1), (0, 0, 0)]
    assert first(features.engineer_clinical_flags(spark.range(1)))["change_flag"] == 0


def test_dispositions(spark):
    df = spark.createDataFrame([(1, 1), (2, 4), (6, 7), (7, 8), (11, 99), (99, None)],
                               "discharge_disposition_id bigint, admission_source_id bigint")
    got = [tuple(r) for r in features.engineer_disposition_features(df).collect()]
    assert got == [("Home", "Referral"), ("Transfer", "Transfer"), ("Home_Health", "Emergency"),
                   ("AMA_Left", "Court_Law"), ("SNF_Rehab", "Other"), ("Other", "Other")]
    absent = first(features.engineer_disposition_features(spark.range(1)))
    assert absent["discharge_disposition_grouped"] == "Other"


def test_full_chain_yields_all_model_columns(spark, sf_dir):
    from checks import fixtures
    from riskloom.plans.training import prepare

    df = prepare(fixtures.encounters(spark, sf_dir))
    assert set(NUMERIC_FEATURES) | set(CATEGORICAL_FEATURES) <= set(df.columns)
    assert not {"diag_1", "insulin", "age", "A1Cresult", "patient_nbr"} & set(df.columns)


def test_features_commute_with_deduplication(spark, sf_dir):
    from checks import fixtures
    from riskloom.plans.training import prepare

    raw = fixtures.encounters(spark, sf_dir)
    other = cleaning.clean_data(
        features.run_feature_engineering(cleaning.deduplicate_patients(raw)), keep=["encounter_id"]
    )
    mine = prepare(raw).select(other.columns)
    assert mine.exceptAll(other).count() == 0 and mine.count() == other.count()


def test_chain_plan_has_no_python_and_no_shuffle(spark, sf_dir):
    stored = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey AS encounter_id", "'250' AS diag_1", "'Up' AS insulin", "1L AS time_in_hospital"
    )
    plan = features.run_feature_engineering(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
