import pytest
from pyspark.sql import functions as F

from caretide import schema as S
from caretide.operators import clean as CL
from caretide.sources import encounters as R, lookups as L


def raw(spark, rows):
    """Raw encounters from dicts; columns not given are null."""
    made = [tuple(row.get(c) for c in S.RAW_COLUMNS) for row in rows]
    return spark.createDataFrame(made, S.RAW_SCHEMA)


ROWS = [
    {"encounter_id": "100", "patient_nbr": "a", "discharge_disposition_id": 11, "readmitted": "NO"},
    {"encounter_id": "1000", "patient_nbr": "a", "discharge_disposition_id": 1, "readmitted": ">30"},
    {"encounter_id": "900", "patient_nbr": "a", "discharge_disposition_id": 1, "readmitted": "<30",
     "race": "?"},
    {"encounter_id": "901", "patient_nbr": "b", "discharge_disposition_id": None, "readmitted": None},
    {"encounter_id": "902", "patient_nbr": "c", "discharge_disposition_id": 20, "readmitted": "NO"},
]


def test_clean(spark):
    got = CL.clean(raw(spark, ROWS))
    rows = {r["row_id"]: r[S.LABEL] for r in got.collect()}
    # the first eligible encounter by number; an unknown disposition stays
    assert rows == {"900": 1, "901": 0}
    assert not {"weight", "payer_code", "patient_nbr", "readmitted", "encounter_id"} & set(got.columns)
    assert got.where("row_id = '900'").first()["race"] is None


def test_cleaning_audit(spark):
    got = {r["step"]: r["n_rows"] for r in CL.cleaning_audit(raw(spark, ROWS)).collect()}
    assert got == {"initial": 5, "removed_terminal": 2, "removed_repeat": 1, "final": 2}


def test_first_encounter_keeps_one_row_before_the_shuffle(spark):
    plan = CL.first_encounter(raw(spark, ROWS), order_col="encounter_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[shuffle:]  # below the exchange in the plan


def test_csv_scan(spark, tmp_path):
    row = {c: "" for c in S.RAW_COLUMNS}
    row.update({"encounter_id": "007", "diag_1": "250.00", "race": "?", "A1Cresult": "None",
                "admission_type_id": "3", "number_inpatient": "?"})
    path = tmp_path / "raw.csv"
    path.write_text(",".join(S.RAW_COLUMNS) + "\n" + ",".join(row[c] for c in S.RAW_COLUMNS) + "\n")
    got = R.read_encounters(spark, str(path)).first()
    assert got["encounter_id"] == "007" and got["diag_1"] == "250.00"
    assert got["race"] is None and got["number_inpatient"] is None
    assert got["A1Cresult"] == "None" and got["admission_type_id"] == 3
    assert R.read_encounters(spark, str(path), null_literals=True).first()["A1Cresult"] is None


def test_missing_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        R.read_encounters(spark, str(tmp_path / "none.csv"))
    with pytest.raises(FileNotFoundError):
        L.read_lookup_file(spark, str(tmp_path / "none.csv"))


def test_label_check(spark):
    good = raw(spark, ROWS)
    assert R.check_labels(good) is good
    bad = good.withColumn("readmitted", F.lit("later"))
    with pytest.raises(ValueError, match="later"):
        R.check_labels(bad)


def test_lookup_file(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text(
        "99,before any section\nadmission_type_id,description\n1,Emergency\n2, Urgent \n,\n"
        'discharge_disposition_id,description\n1,"Home, self care"\nx,not a number\n\n'
        "admission_source_id,description\n7,Emergency Room\n8\n"
    )
    got = {(r[0], r[1]): r[2] for r in L.read_lookup_file(spark, str(path)).collect()}
    assert got == {
        ("admission_type_id", 1): "Emergency", ("admission_type_id", 2): "Urgent",
        ("discharge_disposition_id", 1): "Home, self care",
        ("admission_source_id", 7): "Emergency Room",
    }
    lookups = L.read_lookup_file(spark, str(path))
    assert {r.id: r.description for r in L.source_labels(lookups).collect()} == {7: "Emergency Room"}
    df = spark.createDataFrame([(1,), (9,), (None,)], "admission_type_id int")
    named = L.decode_ids(df, lookups).collect()
    assert {(r[0], r["admission_type_id_label"]) for r in named} == {
        (1, "Emergency"), (9, None), (None, None)
    }


def test_required_columns(spark):
    with pytest.raises(ValueError, match="gender"):
        CL.require_columns(spark.range(1).withColumn("race", F.lit("x")), ["race", "gender"])


def _csv(tmp_path, columns, rows):
    path = tmp_path / "e.csv"
    path.write_text("\n".join([",".join(columns), *(",".join(r) for r in rows)]) + "\n")
    return str(path)


def _raw_row(**changed):
    number = {"admission_type_id", "discharge_disposition_id", "admission_source_id", *S.RAW_NUMERIC}
    row = {c: "1" if c in number else f"{c}-text" for c in S.RAW_COLUMNS}
    return {**row, **changed}


def test_csv_is_read_by_name(spark, tmp_path):
    row = _raw_row(race="Asian", gender="Female", time_in_hospital="4")
    mixed = list(reversed(S.RAW_COLUMNS))
    got = R.read_encounters(spark, _csv(tmp_path, mixed, [[row[c] for c in mixed]])).first()
    assert (got.race, got.gender, got.time_in_hospital) == ("Asian", "Female", 4)
    assert got.__fields__ == S.RAW_COLUMNS


def test_csv_without_a_column_or_with_a_bad_number(spark, tmp_path):
    row = _raw_row()
    short = S.RAW_COLUMNS[1:]
    with pytest.raises(ValueError, match="encounter_id"):
        R.read_encounters(spark, _csv(tmp_path, short, [[row[c] for c in short]]))
    bad = _raw_row(time_in_hospital="abc")
    path = _csv(tmp_path, S.RAW_COLUMNS, [[bad[c] for c in S.RAW_COLUMNS]])
    with pytest.raises(Exception, match="bad number in time_in_hospital: abc"):
        R.read_encounters(spark, path).collect()
    gap = _raw_row(time_in_hospital="?")
    path = _csv(tmp_path, S.RAW_COLUMNS, [[gap[c] for c in S.RAW_COLUMNS]])
    assert R.read_encounters(spark, path).first().time_in_hospital is None
