import json

import pytest

from riskloom.schema import CONTRACT, REQUIRED_COLUMNS, contract_schema
from riskloom.sources import checks, tables

VALID = {
    "age_ordinal": 3, "time_in_hospital": 11, "num_lab_procedures": 87, "num_medications": 29,
    "number_diagnoses": 4, "num_med_changes": 5, "num_meds_active": 6, "total_prior_visits": 12,
    "insulin_changed": 1, "race": "Asian", "gender": "Male", "diag1_category": "Injury",
    "admission_type_id": "3",
}


def request(spark, **changes):
    record = {**VALID, **changes}
    kinds = {f.name: f.dataType.simpleString() for f in contract_schema()}
    schema = ", ".join(f"{k} {kinds[k]}" for k in record)
    return spark.createDataFrame([tuple(record.values())], schema)


def test_markers_become_null_in_every_column(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(
        "encounter_id,patient_nbr,race,A1Cresult,glyburide-metformin,time_in_hospital\n"
        '1,5,?,None,No,3\n2,6,"a, ""b""",>7,NA,x\n3,7,,nan,Up,4.0\n4,?,N/A,Norm,null,\n'
    )
    rows = tables.load_raw_data(spark, str(tmp_path / "raw.csv")).orderBy("encounter_id").collect()
    assert [r["race"] for r in rows] == [None, 'a, "b"', None, None]
    assert [r["A1Cresult"] for r in rows] == [None, ">7", None, "Norm"]
    assert [r["glyburide-metformin"] for r in rows] == ["No", None, "Up", None]
    assert [r["time_in_hospital"] for r in rows] == [3, None, 4, None]
    assert [r["patient_nbr"] for r in rows] == [5, 6, 7, None]


def test_required_columns(spark):
    df = spark.createDataFrame([tuple(range(len(REQUIRED_COLUMNS)))], list(REQUIRED_COLUMNS))
    assert checks.validate_data(df) is df
    with pytest.raises(checks.MissingColumnsError) as error:
        checks.validate_data(df.drop("race", "insulin"))
    assert error.value.missing == ["insulin", "race"]
    assert [r[0] for r in checks.missing_columns(df.drop("race")).collect()] == ["race"]


def test_valid_request_takes_defaults(spark):
    row = checks.apply_contract(request(spark)).first()
    assert row["errors"] == []
    assert (row["num_procedures"], row["medical_specialty_missing"], row["diag2_category"]) == (0, 1, "Other")
    assert row["admission_source_grouped"] == "Other"


@pytest.mark.parametrize("changes, errors", [
    ({"age_ordinal": 15}, ["age_ordinal"]), ({"age_ordinal": -1}, ["age_ordinal"]),
    ({"time_in_hospital": 0}, ["time_in_hospital"]), ({"num_lab_procedures": 132}, []),
    ({"num_lab_procedures": 133}, ["num_lab_procedures"]), ({"gender": None}, ["gender"]),
    ({"total_prior_visits": 101, "insulin_changed": 2}, ["total_prior_visits", "insulin_changed"]),
])
def test_rules(spark, changes, errors):
    assert checks.apply_contract(request(spark, **changes)).first()["errors"] == errors


def test_required_field_absent(spark):
    assert checks.apply_contract(request(spark).drop("gender")).first()["errors"] == ["gender"]


def test_fraction_in_whole_number_field(spark):
    df = request(spark).selectExpr("* EXCEPT (age_ordinal)", "2.5D AS age_ordinal")
    assert checks.apply_contract(df).first()["errors"] == ["age_ordinal"]


def test_split_valid_keeps_every_row(spark):
    df = request(spark).unionByName(request(spark, age_ordinal=15))
    good, bad = checks.split_valid(df)
    assert (good.count(), bad.count()) == (1, 1)
    assert "errors" not in good.columns and bad.first()["errors"] == ["age_ordinal"]


def test_empty_batch_is_refused(spark):
    with pytest.raises(ValueError):
        checks.require_rows(request(spark).limit(0))


def test_records_to_table(spark):
    df = tables.records_to_table(spark, [VALID, {"age_ordinal": 2}])
    assert df.columns == [r.name for r in CONTRACT]
    rows = df.collect()
    assert rows[0]["gender"] == "Male" and rows[1]["gender"] is None
    with pytest.raises(ValueError):
        tables.records_to_table(spark, [{"age_ordinal": 2.5}])


def test_score_request_file_with_broken_line(spark, tmp_path):
    (tmp_path / "r.csv").write_text("gender,age_ordinal,note\nFemale,3,a\nMale,many,b\n")
    df = tables.load_score_requests(spark, str(tmp_path / "r.csv")).cache()
    rows = {r["gender"]: r for r in df.collect()}
    assert rows["Female"]["age_ordinal"] == 3 and rows["Female"]["_corrupt_record"] is None
    assert rows["Male"]["age_ordinal"] is None and "many" in rows["Male"]["_corrupt_record"]
    checked = checks.apply_contract(df).filter("gender = 'Male'").first()
    assert checked["errors"][0] == "_corrupt_record"


def test_csv_sink_with_nested_column(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, array(named_struct('feature', 'a', 'impact', 0.5D)) AS reasons, 'x, y' AS t")
    tables.write_csv(df, str(tmp_path / "out"))
    row = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out")).first()
    assert row["t"] == "x, y" and row["reasons"] == '[{"feature":"a","impact":0.5}]'


def test_preview_is_a_top_n(spark):
    df = tables.preview(spark.range(100), "id", 3)
    assert [r[0] for r in df.collect()] == [0, 1, 2]
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_a_fraction_in_a_whole_number_column_is_an_error(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("encounter_id,time_in_hospital\n1,5.0\n2,5.7\n")
    rows = tables.load_raw_data(spark, str(tmp_path / "raw.csv"))
    assert rows.filter("encounter_id = 1").select("encounter_id").count() == 1
    with pytest.raises(Exception, match="time_in_hospital holds a fraction"):
        rows.collect()


def test_request_files_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("age_ordinal,time_in_hospital,gender\n4,9,Male\n")
    (tmp_path / "b.csv").write_text("gender,time_in_hospital,age_ordinal,num_procedures\nFemale,2,7,3\n")
    rows = tables.load_score_requests(spark, str(tmp_path)).orderBy("age_ordinal").collect()
    got = [(r["age_ordinal"], r["time_in_hospital"], r["gender"], r["num_procedures"]) for r in rows]
    assert got == [(4, 9, "Male", 0), (7, 2, "Female", 3)]


def test_records_take_defaults_and_keep_nulls(spark):
    rows = tables.records_to_table(spark, [VALID, {**VALID, "race": None}])
    good, bad = checks.split_valid(rows)
    assert (good.count(), bad.first()["errors"]) == (1, ["race"])
    assert good.first()["medical_specialty_missing"] == 1


def record_lines(tmp_path, *lines):
    (tmp_path / "r.jsonl").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "r.jsonl")


def test_record_scan_keeps_absent_apart_from_null(spark, tmp_path):
    full = {**VALID, "id": 1, "unknown_field": {"x": [1]}}
    cases = [
        (full, []),
        ({**full, "race": None}, ["race"]),
        ({k: v for k, v in full.items() if k != "gender"}, ["gender"]),
        ({**full, "age_ordinal": "4", "lab_procedure_intensity": "0.5"}, []),
        ({**full, "age_ordinal": 2.5}, ["age_ordinal"]),
        ({**full, "age_ordinal": 2.0}, []),
        ({**full, "age_ordinal": "many", "time_in_hospital": 15}, ["age_ordinal", "time_in_hospital"]),
        ({**full, "gender": 3}, ["gender"]),
        ({**full, "num_procedures": [1]}, ["num_procedures"]),
        ({**full, "num_procedures": {"a": 1}}, ["num_procedures"]),
        ({**full, "num_emergency_visits": 10**30}, ["num_emergency_visits"]),  # beyond whole numbers
    ]
    lines = [json.dumps({**record, "id": i}) for i, (record, _) in enumerate(cases)]
    path = record_lines(tmp_path, *lines, "", "[1, 2]", "5", "null", '{"id": 99', "  ", '{"id": 1, "id": 2}')
    got = tables.load_records(spark, path, {"id": "bigint"}).collect()
    by_id = {r["id"]: r for r in got if r["id"] is not None}
    assert {i: by_id[i]["errors"] for i in range(len(cases))} == {i: e for i, (_, e) in enumerate(cases)}
    assert by_id[0]["medical_specialty_missing"] == 1 and by_id[0]["race"] == full.get("race", "Unknown")
    broken = sorted(r["_corrupt_record"] for r in got if r["id"] is None)
    assert broken == sorted(["[1, 2]", "5", "null", '{"id": 99', '{"id": 1, "id": 2}'])
    assert all(r["errors"] == ["_corrupt_record"] for r in got if r["id"] is None)
    assert all(r["_corrupt_record"] is None for r in by_id.values())


def test_record_scan_of_no_lines(spark, tmp_path):
    rows = tables.load_records(spark, record_lines(tmp_path, ""))
    assert rows.columns == [*(r.name for r in CONTRACT), "errors", "_corrupt_record"] and rows.count() == 0


def test_in_memory_records_never_raise(spark):
    rows = tables.parse_records(tables.records_to_json(spark, [VALID, {**VALID, "age_ordinal": object()}]), "value")
    assert sorted(r["errors"] for r in rows.collect()) == [[], ["age_ordinal"]]
