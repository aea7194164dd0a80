"""Clinical expressions on literal rows, with the known semantic traps."""

import pytest
from pyspark.sql import functions as F

from caretide import schema as S
from caretide.functions import clinical as C, diagnosis as D
from caretide.operators import features as FE


def column(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


def texts(spark, name, values):
    return spark.createDataFrame(list(enumerate(values)), f"i int, `{name}` string")


GROUPS = {
    "250.01": "Diabetes", "250": "Diabetes", "414": "Circulatory", "785": "Circulatory",
    "?": "Missing", None: "Missing", "": "Missing", "NaN": "Missing", "nan": "Missing",
    "Missing": "Missing", "V25": "Other", "E900": "Other", "v25": "Other", "459.81": "Other",
    "519.11": "Other", "785.5": "Other", "250D": "Other", "250f": "Other", " ": "Other",
    " 250.1 ": "Diabetes", "486": "Respiratory", "787": "Digestive", "999": "Injury",
    "999.5": "Other", "715": "Musculoskeletal", "599": "Genitourinary", "140": "Neoplasms",
    "239": "Neoplasms", "251": "Other", "abc": "Other", "4.28e2": "Circulatory",
}


def test_diagnosis_groups(spark):
    df = texts(spark, "code", list(GROUPS))
    got = column(D.with_diagnosis_groups(df, {"code": "g"}), "g")
    assert dict(zip(GROUPS, got)) == GROUPS


def test_diagnosis_columns_and_flag(spark):
    rows = [(0, "250.00", "V45.81", "785"), (1, "414.00", "250.01", "460"), (2, "?", "NaN", "E99")]
    df = FE.add_diagnosis_groups(
        spark.createDataFrame(rows, "i int, diag_1 string, diag_2 string, diag_3 string")
    )
    assert column(df, "has_diabetes_diag") == [1, 1, 0]
    assert column(df, "diag_1_group") == ["Diabetes", "Circulatory", "Missing"]
    assert column(df, "diag_3_group") == ["Circulatory", "Respiratory", "Other"]


def test_flag_needs_all_three_codes(spark):
    df = spark.createDataFrame([(0, "250")], "i int, diag_1 string")
    assert "has_diabetes_diag" not in FE.add_diagnosis_groups(df).columns


def test_age(spark):
    df = FE.add_age(texts(spark, "age", ["[0-10)", "[50-60)", "[90-100)", "old", None]))
    assert column(df, "age_midpoint") == [5, 55, 95, None, None]
    bands = df.withColumn("band", C.age_band(F.col("age_midpoint")))
    assert column(bands, "band") == ["[0-10)", "[50-60)", "[90-100)", None, None]
    low = df.withColumn("low", C.age_lower_bound(F.col("age")))
    assert column(low, "low") == [0, 50, 90, None, None]


def medications(spark, *rows):
    made = [
        (i, *[given.get(m, "No") for m in S.MEDICATIONS]) for i, given in enumerate(rows)
    ]
    return spark.createDataFrame(
        made, "i int, " + ", ".join(f"`{m}` string" for m in S.MEDICATIONS)
    )


def test_medications(spark):
    df = FE.add_medications(medications(
        spark, {}, {"insulin": "Steady", "metformin": "Up"},
        {"insulin": "Up", "metformin": "Down"}, {"glipizide": None, "insulin": "odd"},
    ))
    assert column(df, "polypharmacy_score") == [0, 1, 2, 2]
    assert column(df, "num_active_medications") == [0, 2, 2, 2]
    assert column(df, "insulin_intensity") == [0, 1, 3, 0]
    assert not set(S.MEDICATIONS) & set(df.columns)


def test_medications_need_all_columns(spark):
    with pytest.raises(ValueError, match="missing required columns"):
        FE.add_medications(texts(spark, "insulin", ["No"]))


def test_nulls_count_as_no(spark):
    df = spark.createDataFrame(
        [(0, 1, None, 2), (1, None, None, None), (2, 0, 0, 1)],
        "i int, number_outpatient int, number_emergency int, number_inpatient int",
    )
    made = FE.add_utilization(df)
    assert column(made, "total_prior_visits") == [3, 0, 1]
    assert column(made, "high_utilizer_flag") == [1, 0, 0]
    flags = FE.add_flags(texts(spark, "change", ["Ch", "No", None]))
    assert column(flags, "change_binary") == [1, 0, 0]
    labs = FE.add_labs(texts(spark, "A1Cresult", [">7", "None", None, "Norm"]))
    assert column(labs, "a1c_tested") == [1, 0, 0, 1]
    assert column(labs, "a1c_abnormal") == [1, 0, 0, 0]


def test_groupings(spark):
    ids = spark.createDataFrame(
        [(i, v) for i, v in enumerate([1, 6, 8, 22, 30, 7, None])],
        "i int, discharge_disposition_id int",
    )
    assert column(FE.add_groups(ids), "discharge_category") == [
        "Home", "Home Health", "Home Health", "Transfer/SNF", "Transfer/SNF", "Other", "Other"
    ]
    types = spark.createDataFrame(
        [(i, v) for i, v in enumerate([1, 2, 3, 4, None])], "i int, admission_type_id int"
    )
    assert column(FE.add_groups(types), "admission_category") == [
        "Emergency", "Urgent", "Elective", "Other", "Other"
    ]
    special = texts(spark, "medical_specialty", [None, "Cardiology", "Urology"])
    assert column(FE.add_groups(special), "medical_specialty_grouped") == [
        "Unknown", "Cardiology", "Other"
    ]


def test_comorbidity_counts_a_category_once(spark):
    rows = [
        (0, "428.0", "428.1", None),   # heart failure once: 7
        (1, "278.0", "304", "?"),      # obesity -4, no prefix for drugs
        (2, "401", "250", "nan"),      # weight 0
        (3, " v42.0 ", "197", "9428"),  # renal 5, metastatic 12; 428 not at the start
        (4, "3980918", "x398.91", "398.91"),  # the dot is a dot; match at the start
    ]
    df = FE.add_comorbidity(
        spark.createDataFrame(rows, "i int, diag_1 string, diag_2 string, diag_3 string")
    )
    assert column(df, "elixhauser_score") == [7.0, -4.0, 0.0, 17.0, 7.0]


def test_band_and_default(spark):
    df = spark.createDataFrame(
        [(0, 0.3, 2.5), (1, 0.2, 3.5), (2, 0.19, 99.0)], "i int, score double, value double"
    ).withColumns({
        "band": C.risk_band(F.col("score"), F.lit(0.2)),
        "clipped": C.clipped_default(F.col("value"), 1, 14),
    })
    assert column(df, "band") == ["Watchlist", "Watchlist", "Lower risk"]
    assert column(df, "clipped") == [2, 4, 14]  # halves go to the even number
