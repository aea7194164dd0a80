"""Column names, types and fixed values of the encounter data model.

Everything here is plain data. The values must equal the published data
dictionary for results to be right, so they are listed as they are, in their
natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: columns -------------------------------------------------

MEDICATIONS = [
    "metformin", "repaglinide", "nateglinide", "chlorpropamide", "glimepiride",
    "acetohexamide", "glipizide", "glyburide", "tolbutamide", "pioglitazone",
    "rosiglitazone", "acarbose", "miglitol", "troglitazone", "tolazamide",
    "examide", "citoglipton", "insulin", "glyburide-metformin",
    "glipizide-metformin", "glimepiride-pioglitazone",
    "metformin-rosiglitazone", "metformin-pioglitazone",
]

DIAGNOSES = ["diag_1", "diag_2", "diag_3"]

NUMERIC = [
    "time_in_hospital", "num_lab_procedures", "num_procedures",
    "num_medications", "number_outpatient", "number_emergency",
    "number_inpatient", "number_diagnoses", "age_midpoint",
    "polypharmacy_score", "total_prior_visits", "num_active_medications",
    "insulin_intensity", "elixhauser_score",
]
CATEGORICAL = [
    "race", "gender", "admission_category", "discharge_category",
    "admission_source_id", "medical_specialty_grouped", "diag_1_group",
    "diag_2_group", "diag_3_group",
]
BINARY = [
    "change_binary", "diabetesMed_binary", "has_diabetes_diag", "a1c_tested",
    "a1c_abnormal", "glu_tested", "glu_abnormal", "high_utilizer_flag",
]
FEATURES = NUMERIC + CATEGORICAL + BINARY

RAW_LABEL = "readmitted"
LABEL = "readmitted_30day"
ROW_ID = "row_id"
SPARSE_COLUMNS = ["weight", "payer_code"]

VISIT_COLUMNS = ["number_outpatient", "number_emergency", "number_inpatient"]
RAW_NUMERIC = NUMERIC[:8]
ID_COLUMNS = ["admission_type_id", "discharge_disposition_id", "admission_source_id"]
FORM_OPTIONS = [
    "admission_category", "admission_source_id", "diag_1_group",
    "discharge_category", "gender", "medical_specialty_grouped", "race",
]

# --- fixed values: codes and maps ------------------------------------------

MISSING = "?"
NULL_LITERALS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
RAW_LABELS = ["NO", ">30", "<30"]
LABEL_VALUES = {"<30": 1, ">30": 0, "NO": 0}
TERMINAL_DISPOSITIONS = [11, 13, 14, 19, 20, 21]
EXPECTED_ROWS = 101_766
EXPECTED_COLUMNS = 50

AGE_MIDPOINTS = {
    "[0-10)": 5, "[10-20)": 15, "[20-30)": 25, "[30-40)": 35, "[40-50)": 45,
    "[50-60)": 55, "[60-70)": 65, "[70-80)": 75, "[80-90)": 85, "[90-100)": 95,
}
INSULIN_LEVELS = {"No": 0, "Steady": 1, "Down": 2, "Up": 3}
ADMISSION_GROUPS = {1: "Emergency", 2: "Urgent", 3: "Elective"}
DISCHARGE_GROUPS = {
    "Home": [1],
    "Home Health": [6, 8],
    "Transfer/SNF": [2, 3, 4, 5, 22, 23, 24, 27, 28, 29, 30],
}
KEPT_SPECIALTIES = [
    "Unknown", "InternalMedicine", "Emergency/Trauma",
    "Family/GeneralPractice", "Cardiology", "Surgery-General",
]

# Diagnosis groups: (name, lowest, highest, closed on the right, single code).
DIAGNOSIS_GROUPS = [
    ("Diabetes", 250, 251, False, None),
    ("Circulatory", 390, 459, True, 785),
    ("Respiratory", 460, 519, True, 786),
    ("Digestive", 520, 579, True, 787),
    ("Injury", 800, 999, True, None),
    ("Musculoskeletal", 710, 739, True, None),
    ("Genitourinary", 580, 629, True, 788),
    ("Neoplasms", 140, 239, True, None),
]
MISSING_DIAGNOSES = ["?", "Missing", "NaN", "nan", ""]

# Comorbidity weights (van Walraven) and the code prefixes that raise each
# category; weights without prefixes never match.
COMORBIDITY_WEIGHTS = {
    "congestive_heart_failure": 7, "cardiac_arrhythmia": 5,
    "valvular_disease": -1, "pulmonary_circulation": 4,
    "peripheral_vascular": 2, "hypertension": 0, "paralysis": 7,
    "other_neurological": 6, "chronic_pulmonary": 3, "diabetes": 0,
    "hypothyroidism": 0, "renal_failure": 5, "liver_disease": 11,
    "peptic_ulcer": 0, "aids_hiv": 0, "lymphoma": 9, "metastatic_cancer": 12,
    "solid_tumor": 4, "rheumatoid_arthritis": 0, "coagulopathy": 3,
    "obesity": -4, "weight_loss": 6, "fluid_electrolyte": 5,
    "blood_loss_anemia": -2, "deficiency_anemia": -2, "alcohol_abuse": 0,
    "drug_abuse": -7, "psychoses": 0, "depression": -3,
}
COMORBIDITY_PREFIXES = {
    "congestive_heart_failure": ["398.91", "428"],
    "cardiac_arrhythmia": ["426", "427"],
    "valvular_disease": ["093.2", "394", "395", "396", "397", "424", "V42.2", "V43.3"],
    "pulmonary_circulation": ["416", "417.9"],
    "peripheral_vascular": ["440", "441", "442", "443", "444", "447.1", "449", "V43.4"],
    "hypertension": ["401"],
    "paralysis": ["342", "343", "344"],
    "other_neurological": [
        "331.9", "332", "333", "334", "335", "336", "340", "341", "345", "348",
        "349", "780.3", "784.3",
    ],
    "chronic_pulmonary": [
        "490", "491", "492", "493", "494", "495", "496", "500", "501", "502",
        "503", "504", "505",
    ],
    "renal_failure": ["584", "585", "586", "V42.0", "V45.1", "V56"],
    "liver_disease": [
        "070.22", "070.23", "070.32", "070.33", "070.44", "070.54", "456.0",
        "456.1", "456.2", "570", "571", "572", "573.3", "573.4", "573.8",
        "573.9", "V42.7",
    ],
    "metastatic_cancer": ["196", "197", "198", "199"],
    "solid_tumor": ["14", "15", "16", "17", "18", "190", "191", "192", "193", "194", "195"],
    "fluid_electrolyte": ["276"],
    "weight_loss": ["260", "261", "262", "263", "783.2", "799.4"],
    "coagulopathy": ["286", "287.1", "287.3", "287.4", "287.5"],
    "lymphoma": ["200", "201", "202", "203", "204", "205", "206", "207", "208"],
    "obesity": ["278.0"],
}

# --- fixed values: evaluation and training ---------------------------------

SEED = 42
TEST_SHARE = "0.15"
VALIDATION_SHARE = "0.15"
FALSE_NEGATIVE_COST = 5.0
FALSE_POSITIVE_COST = 1.0
ALERT_NOBODY = 1.0000000000000002  # smallest double above 1
CASE_CUT = 0.1
COHORT_SIZE = 501
BUNDLE_PARTS = [
    "admission_source_labels", "cohort_X", "cohort_y", "feature_names",
    "form_defaults", "form_options", "pipeline", "threshold",
]
AUDIT_ATTRIBUTES = {"Race": "race", "Gender": "gender", "Age": "age"}

BOOSTED_DEFAULTS = {
    "max_depth": 6, "learning_rate": 0.1, "n_estimators": 300, "subsample": 0.8,
    "colsample": 0.8, "min_child_weight": 5, "min_info_gain": 0.0,
}
SEARCH_RANGES = {
    "max_depth": ("int", 3, 10),
    "learning_rate": ("log", 0.01, 0.3),
    "n_estimators": ("int", 100, 1000),
    "subsample": ("float", 0.6, 1.0),
    "colsample": ("float", 0.5, 1.0),
    "min_child_weight": ("int", 1, 10),
    # a drop in variance per row; the usual 0 to 5 of a summed loss would forbid all splits
    "min_info_gain": ("log", 1e-6, 5e-2),
}

# --- table types ------------------------------------------------------------

_INTEGERS = {*ID_COLUMNS, *RAW_NUMERIC}
RAW_COLUMNS = (
    ["encounter_id", "patient_nbr", "race", "gender", "age", "weight"]
    + ID_COLUMNS
    + ["time_in_hospital", "payer_code", "medical_specialty"]
    + ["num_lab_procedures", "num_procedures", "num_medications"]
    + VISIT_COLUMNS
    + DIAGNOSES
    + ["number_diagnoses", "max_glu_serum", "A1Cresult"]
    + MEDICATIONS
    + ["change", "diabetesMed", RAW_LABEL]
)
RAW_SCHEMA = T.StructType([
    T.StructField(c, T.IntegerType() if c in _INTEGERS else T.StringType())
    for c in RAW_COLUMNS
])
