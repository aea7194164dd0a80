"""Cleaning and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from caretide import schema as S
from caretide.functions import clinical as C, diagnosis as D
from caretide.functions.clinical import column
from caretide.operators import clean as CL, explore as X, features as FE
from caretide.operators.serve import band_scores
from caretide.plans import oracle as O, tables as T
from caretide.plans.oracle import columns, q, sql
from caretide.plans.registry import query, rounded
from caretide.sources.order_view import encounters

_ID = "encounter_id"


@query("p01_replace_sentinel", sql(f"SELECT {columns(S.RAW_COLUMNS)} FROM t_null"))
def _(spark, sf_dir):
    return CL.replace_sentinel(encounters(spark, sf_dir))


@query("p02_drop_unused", sql("""SELECT * EXCLUDE (weight, payer_code, encounter_id),
    encounter_id AS row_id FROM t_null"""))
def _(spark, sf_dir):
    return CL.drop_unused(T.loaded(spark, sf_dir))


@query("p03_exclude_terminal",
       sql("SELECT encounter_id, patient_nbr, discharge_disposition_id FROM t_eligible"))
def _(spark, sf_dir):
    return CL.exclude_terminal(
        T.loaded(spark, sf_dir, _ID, "patient_nbr", "discharge_disposition_id")
    )


@query("p04_first_encounter", sql(f"SELECT {columns([c for c in S.RAW_COLUMNS if c != 'patient_nbr'])} FROM t_first"))
def _(spark, sf_dir):
    eligible = CL.exclude_terminal(T.loaded(spark, sf_dir))
    return CL.first_encounter(eligible, order_col=_ID)


@query("p05_binarize_label",
       sql(f"SELECT encounter_id, {O.LABEL_CASE} AS {S.LABEL} FROM t_null"))
def _(spark, sf_dir):
    return CL.binarize_label(T.loaded(spark, sf_dir, _ID, S.RAW_LABEL))


@query("p06_label_map", sql("""SELECT encounter_id, CASE WHEN time_in_hospital = 7 THEN NULL
    WHEN readmitted = '<30' THEN 1 ELSE 0 END AS readmitted_binary FROM t_null"""))
def _(spark, sf_dir):
    df = T.loaded(spark, sf_dir, _ID, S.RAW_LABEL, "time_in_hospital")
    value = F.when(F.col("time_in_hospital") != 7, F.col(S.RAW_LABEL))
    return df.select(_ID, C.label_mapped(value).alias("readmitted_binary"))


@query("p07_cleaning_audit", sql("""SELECT 'initial' AS step, count(*) AS n_rows FROM t_null
    UNION ALL SELECT 'removed_terminal', (SELECT count(*) FROM t_null)
        - (SELECT count(*) FROM t_eligible)
    UNION ALL SELECT 'removed_repeat', (SELECT count(*) FROM t_eligible)
        - (SELECT count(*) FROM t_first)
    UNION ALL SELECT 'final', count(*) FROM t_first"""))
def _(spark, sf_dir):
    return CL.cleaning_audit(
        T.loaded(spark, sf_dir, "patient_nbr", "discharge_disposition_id")
    )


@query("p08_clean", sql("SELECT * FROM t_clean"))
def _(spark, sf_dir):
    return CL.clean(encounters(spark, sf_dir))


@query("p09_modelling_columns", sql("SELECT * FROM t_model"))
def _(spark, sf_dir):
    return T.modelling(spark, sf_dir)


@query("p10_keep_top_codes", sql("""SELECT encounter_id, diag_1 FROM t_null WHERE diag_1 IN
    (SELECT diag_1 FROM t_null WHERE diag_1 IS NOT NULL GROUP BY diag_1
     ORDER BY count(*) DESC, diag_1 LIMIT 20)"""))
def _(spark, sf_dir):
    df = T.loaded(spark, sf_dir, _ID, "diag_1")
    # the limit bounds the broadcast side
    return CL.keep_values(df, F.broadcast(X.top_keys(df, "diag_1").select("diag_1")), "diag_1")


# --- scalar functions -------------------------------------------------------


@query("f01_age_midpoint", sql(f"SELECT encounter_id, age, {O.MIDPOINT} AS age_midpoint FROM t_null"))
def _(spark, sf_dir):
    return FE.add_age(T.loaded(spark, sf_dir, _ID, "age"))


@query("f02_age_band", sql(f"SELECT encounter_id, age_midpoint, age AS age_band FROM (SELECT encounter_id, age, {O.MIDPOINT} AS age_midpoint FROM t_null)"))
def _(spark, sf_dir):
    df = FE.add_age(T.loaded(spark, sf_dir, _ID, "age"))
    return df.select(_ID, "age_midpoint", C.age_band(F.col("age_midpoint")).alias("age_band"))


@query("f03_prior_visits", sql(f"SELECT encounter_id, {O.VISITS} AS total_prior_visits FROM t_null"))
def _(spark, sf_dir):
    df = FE.add_utilization(T.loaded(spark, sf_dir, _ID, *S.VISIT_COLUMNS))
    return df.select(_ID, "total_prior_visits")


@query("f04_high_utilizer", sql(f"SELECT encounter_id, number_inpatient, {O.UTILIZER} AS high_utilizer_flag FROM t_null"))
def _(spark, sf_dir):
    return FE.add_utilization(T.loaded(spark, sf_dir, _ID, "number_inpatient"))


def _medications(spark, sf_dir):
    return FE.add_medications(T.loaded(spark, sf_dir, _ID, *S.MEDICATIONS))


@query("f05_medication_burden", sql(f"SELECT encounter_id, {O.BURDEN} AS polypharmacy_score FROM t_null"))
def _(spark, sf_dir):
    return _medications(spark, sf_dir).select(_ID, "polypharmacy_score")


@query("f06_active_medications", sql(f"SELECT encounter_id, {O.ACTIVE} AS num_active_medications FROM t_null"))
def _(spark, sf_dir):
    return _medications(spark, sf_dir).select(_ID, "num_active_medications")


@query("f07_insulin_level", sql(f"SELECT encounter_id, {O.INSULIN} AS insulin_intensity FROM t_null"))
def _(spark, sf_dir):
    return _medications(spark, sf_dir).select(_ID, "insulin_intensity")


@query("f08_fold_medications", sql(f"""SELECT encounter_id, {O.BURDEN} AS polypharmacy_score,
    {O.ACTIVE} AS num_active_medications, {O.INSULIN} AS insulin_intensity FROM t_null"""))
def _(spark, sf_dir):
    return _medications(spark, sf_dir)


@query("f09_equality_flags", sql(f"SELECT encounter_id, change, \"diabetesMed\", {O._select(O.FLAGS)} FROM t_null"))
def _(spark, sf_dir):
    return FE.add_flags(T.loaded(spark, sf_dir, _ID, "change", "diabetesMed"))


@query("f10_a1c_flags", sql(f"SELECT encounter_id, \"A1Cresult\", {O._select({k: v for k, v in O.LABS.items() if k[0] == 'a'})} FROM t_null"))
def _(spark, sf_dir):
    return FE.add_labs(T.loaded(spark, sf_dir, _ID, "A1Cresult"))


@query("f11_glucose_flags", sql(f"SELECT encounter_id, max_glu_serum, {O._select({k: v for k, v in O.LABS.items() if k[0] == 'g'})} FROM t_null"))
def _(spark, sf_dir):
    return FE.add_labs(T.loaded(spark, sf_dir, _ID, "max_glu_serum"))


@query("f12_discharge_group", sql(f"SELECT encounter_id, discharge_disposition_id, {O.DISCHARGE} AS discharge_category FROM t_null"))
def _(spark, sf_dir):
    return FE.add_groups(T.loaded(spark, sf_dir, _ID, "discharge_disposition_id"))


@query("f13_admission_group", sql(f"SELECT encounter_id, admission_type_id, {O.ADMISSION} AS admission_category FROM t_null"))
def _(spark, sf_dir):
    return FE.add_groups(T.loaded(spark, sf_dir, _ID, "admission_type_id"))


@query("f14_specialty_group", sql(f"SELECT encounter_id, medical_specialty, {O.SPECIALTY} AS medical_specialty_grouped FROM t_null"))
def _(spark, sf_dir):
    return FE.add_groups(T.loaded(spark, sf_dir, _ID, "medical_specialty"))


@query("f15_race_unknown", sql("SELECT encounter_id, coalesce(race, 'Unknown') AS race FROM t_null"))
def _(spark, sf_dir):
    return FE.add_groups(T.loaded(spark, sf_dir, _ID, "race"))


@query("f16_diagnosis_group", sql(f"""SELECT code, {O.icd_group('code')} AS diagnosis_group, count(*) AS n
    FROM (SELECT diag_1 AS code FROM t_raw UNION ALL SELECT diag_2 FROM t_raw
    UNION ALL SELECT diag_3 FROM t_raw) GROUP BY code"""))
def _(spark, sf_dir):
    codes = encounters(spark, sf_dir, S.DIAGNOSES).unpivot([], S.DIAGNOSES, "which", "code")
    counts = codes.groupBy("code").agg(F.count("*").alias("n"))
    return D.with_diagnosis_groups(counts, {"code": "diagnosis_group"})


@query("f17_diagnosis_columns", sql(f"SELECT encounter_id, {O._select(O._GROUPS)} FROM t_null"))
def _(spark, sf_dir):
    df = FE.add_diagnosis_groups(T.loaded(spark, sf_dir, _ID, *S.DIAGNOSES))
    return df.select(_ID, *[f"{c}_group" for c in S.DIAGNOSES])


@query("f18_any_diabetes", sql(f"SELECT encounter_id, CAST('Diabetes' IN ({', '.join(O._GROUPS.values())}) AS INT) AS has_diabetes_diag FROM t_null"))
def _(spark, sf_dir):
    df = FE.add_diagnosis_groups(T.loaded(spark, sf_dir, _ID, *S.DIAGNOSES))
    return df.select(_ID, "has_diabetes_diag")


@query("f19_matching_code", sql("""SELECT encounter_id, CASE WHEN diag_1 IS NULL OR diag_1 = '?'
    OR lower(diag_1) = 'nan' THEN '' ELSE upper(trim(diag_1)) END AS code FROM t_raw"""))
def _(spark, sf_dir):
    df = encounters(spark, sf_dir, [_ID, "diag_1"])
    return df.select(_ID, D.matching_code("diag_1").alias("code"))


@query("f20_comorbidity_flags", sql(f"SELECT encounter_id, {', '.join(f'{O.category_flag(c)} AS {c}' for c in S.COMORBIDITY_PREFIXES)} FROM t_null"))
def _(spark, sf_dir):
    return FE.comorbidity_table(T.loaded(spark, sf_dir, _ID, *S.DIAGNOSES), _ID)


@query("f21_comorbidity_score", sql(f"SELECT encounter_id, {O.comorbidity()} AS elixhauser_score FROM t_null"))
def _(spark, sf_dir):
    df = FE.add_comorbidity(T.loaded(spark, sf_dir, _ID, *S.DIAGNOSES))
    return df.select(_ID, "elixhauser_score")


@query("f22_comorbidity_summary", sql(f"""SELECT {O.r6('avg(s)')} AS mean_score,
    {O.r6('avg(CAST(s > 0 AS INT))')} AS positive_share
    FROM (SELECT {O.comorbidity()} AS s FROM t_null)"""))
def _(spark, sf_dir):
    df = FE.add_comorbidity(T.loaded(spark, sf_dir, *S.DIAGNOSES))
    return rounded(FE.comorbidity_summary(df))


@query("f23_feature_table", sql("SELECT * FROM t_engineered"))
def _(spark, sf_dir):
    return T.engineered(spark, sf_dir)


@query("f24_age_lower_bound", sql("""SELECT DISTINCT age,
    CAST(regexp_extract(age, '^\\[(\\d+)', 1) AS INT) AS lower_bound FROM t_null"""))
def _(spark, sf_dir):
    ages = T.loaded(spark, sf_dir, "age").distinct()
    return ages.withColumn("lower_bound", C.age_lower_bound(F.col("age")))


@query("f25_clipped_default", sql("""SELECT encounter_id, CAST(least(greatest(
    round_even(num_lab_procedures / 8.0::DOUBLE, 0), 1), 14) AS INT) AS clipped FROM t_null"""))
def _(spark, sf_dir):
    df = T.loaded(spark, sf_dir, _ID, "num_lab_procedures")
    return df.select(_ID, C.clipped_default(F.col("num_lab_procedures") / 8, 1, 14).alias("clipped"))


@query("f26_risk_band", sql("""SELECT row_id, CASE WHEN score >= 0.4 * 1.5 THEN 'High risk'
    WHEN score >= 0.4 THEN 'Watchlist' ELSE 'Lower risk' END AS risk_band,
    CAST(score >= 0.4 AS INT) AS above_threshold FROM t_wide_scores""".replace("0.4", "0.4::DOUBLE").replace("1.5", "1.5::DOUBLE")))
def _(spark, sf_dir):
    df = T.boosted_scores(spark, sf_dir).select("row_id", "score")
    return band_scores(df, 0.4).drop("score")
