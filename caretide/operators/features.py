"""Feature derivation over cleaned encounters.

Each step adds columns by one projection and is skipped when its source
columns are absent, so the steps compose on partial tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caretide import schema as S
from caretide.functions import clinical as C
from caretide.functions import diagnosis as D
from caretide.functions.clinical import column
from caretide.operators.clean import clean, require_columns


def _has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def add_diagnosis_groups(df: DataFrame) -> DataFrame:
    present = [c for c in S.DIAGNOSES if c in df.columns]
    df = D.with_diagnosis_groups(df, {c: f"{c}_group" for c in present})
    if len(present) == len(S.DIAGNOSES):
        groups = [column(f"{c}_group") for c in S.DIAGNOSES]
        df = df.withColumn("has_diabetes_diag", D.any_diabetes(groups))
    return df


def add_age(df: DataFrame) -> DataFrame:
    if not _has(df, "age"):
        return df
    return df.withColumn("age_midpoint", C.age_midpoint(column("age")))


def add_utilization(df: DataFrame) -> DataFrame:
    added = {}
    if _has(df, *S.VISIT_COLUMNS):
        added["total_prior_visits"] = C.prior_visits(*[column(c) for c in S.VISIT_COLUMNS])
    if _has(df, "number_inpatient"):
        added["high_utilizer_flag"] = C.high_utilizer(column("number_inpatient"))
    return df.withColumns(added) if added else df


def add_medications(df: DataFrame) -> DataFrame:
    """Fold the medication columns, all of which must exist, into three."""
    require_columns(df, S.MEDICATIONS)
    return df.withColumns({
        "polypharmacy_score": C.medication_burden(),
        "num_active_medications": C.active_medications(),
        "insulin_intensity": C.insulin_level(column("insulin")),
    }).drop(*S.MEDICATIONS)


def add_flags(df: DataFrame) -> DataFrame:
    added = {}
    if _has(df, "change"):
        added["change_binary"] = C.equals_flag(column("change"), "Ch")
    if _has(df, "diabetesMed"):
        added["diabetesMed_binary"] = C.equals_flag(column("diabetesMed"), "Yes")
    return df.withColumns(added) if added else df


def add_labs(df: DataFrame) -> DataFrame:
    added = {}
    if _has(df, "A1Cresult"):
        added["a1c_tested"] = C.lab_tested(column("A1Cresult"))
        added["a1c_abnormal"] = C.lab_abnormal(column("A1Cresult"), [">7", ">8"])
    if _has(df, "max_glu_serum"):
        added["glu_tested"] = C.lab_tested(column("max_glu_serum"))
        added["glu_abnormal"] = C.lab_abnormal(column("max_glu_serum"), [">200", ">300"])
    return df.withColumns(added) if added else df


def add_groups(df: DataFrame) -> DataFrame:
    added = {}
    if _has(df, "discharge_disposition_id"):
        added["discharge_category"] = C.discharge_group(column("discharge_disposition_id"))
    if _has(df, "admission_type_id"):
        added["admission_category"] = C.admission_group(column("admission_type_id"))
    if _has(df, "medical_specialty"):
        added["medical_specialty_grouped"] = C.specialty_group(column("medical_specialty"))
    df = df.withColumns(added) if added else df
    return df.na.fill({"race": "Unknown"}) if _has(df, "race") else df


def add_comorbidity(df: DataFrame) -> DataFrame:
    codes = [c for c in S.DIAGNOSES if c in df.columns]
    # named first, so the joined text is built once for all categories
    return (
        df.withColumn("_codes", D.joined_codes(codes))
        .withColumn("elixhauser_score", D.comorbidity_score("_codes"))
        .drop("_codes")
    )


def comorbidity_table(df: DataFrame, *keep: str) -> DataFrame:
    """The categories as 0/1 columns next to ``keep``."""
    codes = [c for c in S.DIAGNOSES if c in df.columns]
    named = df.select(*[column(k) for k in keep], D.joined_codes(codes).alias("_codes"))
    return named.withColumns(D.comorbidity_flags("_codes")).drop("_codes")


def derive_features(df: DataFrame) -> DataFrame:
    return (
        df.transform(add_age)
        .transform(add_utilization)
        .transform(add_medications)
        .transform(add_flags)
        .transform(add_labs)
        .transform(add_groups)
    )


def engineered_table(raw: DataFrame) -> DataFrame:
    """Raw encounters to one feature row per patient."""
    return (
        raw.transform(clean)
        .transform(add_diagnosis_groups)
        .transform(derive_features)
        .transform(add_comorbidity)
    )


def modelling_table(raw: DataFrame) -> DataFrame:
    """Row id, the model's features in order, and the label."""
    return require_columns(engineered_table(raw), [S.ROW_ID, *S.FEATURES, S.LABEL])


def comorbidity_summary(df: DataFrame) -> DataFrame:
    """Mean score and the share of rows with a positive score."""
    score = column("elixhauser_score")
    return df.agg(
        F.avg(score).alias("mean_score"),
        F.avg((score > 0).cast("int")).alias("positive_share"),
    )
