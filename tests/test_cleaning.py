from pyspark.sql import functions as F

from riskloom.operators import cleaning, fairness, lookups
from riskloom.schema import CATEGORICAL_FEATURES, DISCHARGE_GROUPS, NUMERIC_FEATURES

SCHEMA = ("encounter_id bigint, patient_nbr bigint, race string, weight string, payer_code string, "
          "medical_specialty string, admission_type_id bigint, readmitted string")
ROWS = [
    (1, 10, "Caucasian", None, "MC", "Cardiology", 1, "<30"),
    (2, 10, "Caucasian", None, "MC", None, 2, ">30"),
    (3, 20, None, "x", None, None, 3, "NO"),
    (4, 30, "Asian", None, None, "Surgery", 1, None),
]


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_clean_data(spark):
    out = cleaning.clean_data(frame(spark))
    assert set(out.columns) == {"race", "admission_type_id", "readmitted", "medical_specialty_missing"}
    assert sorted((r["readmitted"], r["medical_specialty_missing"], r["admission_type_id"]) for r in out.collect()) == [
        (0, 0, "1"), (0, 1, "2"), (0, 1, "3"), (1, 0, "1"),
    ]


def test_clean_data_without_specialty(spark):
    out = cleaning.clean_data(frame(spark).drop("medical_specialty"), keep=["encounter_id"])
    assert {r["medical_specialty_missing"] for r in out.collect()} == {1}
    assert "encounter_id" in out.columns


def test_first_encounter_per_patient(spark):
    kept = cleaning.deduplicate_patients(frame(spark)).select("encounter_id").collect()
    assert sorted(r[0] for r in kept) == [1, 3, 4]


def test_deduplication_of_a_patient_with_most_rows(spark):
    rows = spark.range(30_000, numPartitions=8).selectExpr(
        "id AS encounter_id", "IF(id % 3 = 0, 7, id + 100) AS patient_nbr", "string(id) AS note"
    )
    out = cleaning.deduplicate_patients(rows)
    assert out.count() == 20_001
    assert out.filter("patient_nbr = 7").first()["encounter_id"] == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    # One group limit ahead of the exchange, one behind it.
    assert plan.count("WindowGroupLimit") >= 2


def test_deduplication_reads_only_used_columns(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumnsRenamed(
        {"o_custkey": "patient_nbr", "o_orderkey": "encounter_id"}
    )
    plan = cleaning.deduplicate_patients(orders).select("encounter_id")._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan


def test_missing_patients_count_as_one(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5)], "encounter_id bigint, patient_nbr bigint")
    assert cleaning.deduplicate_patients(df).count() == 2


def test_contract_fill(spark):
    df = spark.createDataFrame([(1, 7, None, "x")], "encounter_id int, age_ordinal int, time_in_hospital int, extra string")
    out = cleaning.fill_contract(df, keep=["encounter_id"])
    assert out.columns == ["encounter_id", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    row = out.first()
    assert row["age_ordinal"] == 7 and row["time_in_hospital"] is None
    assert row["num_procedures"] == 0 and row["race"] == "Other"


def test_feature_columns_follow_the_table(spark):
    df = spark.createDataFrame([(1, "a", 2)], "num_procedures int, race string, other int")
    assert cleaning.feature_columns(df) == (["num_procedures"], ["race"])
    assert cleaning.select_model_columns(df, ["other"]).columns == ["other", "num_procedures", "race"]


def test_lookup_join(spark):
    dim = lookups.code_group_dim(spark, DISCHARGE_GROUPS)
    df = spark.createDataFrame([(1,), (11,), (77,), (None,)], "code_id bigint")
    out = lookups.lookup_join(df, dim, "code_id", "grp", "g", "Other")
    assert {(r["code_id"], r["g"]) for r in out.collect()} == {(1, "Home"), (11, "SNF_Rehab"), (77, "Other"), (None, "Other")}


def test_icd_join_agrees_with_case(spark):
    from riskloom.functions.codes import icd9_category

    codes = [None, "785", "785.5", "250.1", "V1", "239.99", "1000", "x", "788.0", "99999999999"]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    out = lookups.icd_category_join(df, "code", "j").withColumn("c", F.expr(icd9_category("code")))
    assert out.count() == len(codes)
    assert out.filter("j <> c").count() == 0


def test_alignment_by_key(spark):
    left = spark.createDataFrame([(1, 0), (2, 1)], "id int, y int")
    right = spark.createDataFrame([(2, "b"), (1, "a")], "id int, g string")
    assert {tuple(r) for r in fairness.align_by_key(left, right, "id").collect()} == {(1, 0, "a"), (2, 1, "b")}
