"""The registered queries against their SQL, on the smallest tables.

``python -m tests.oracle_check`` compares every query at sf0.01.
"""

import pytest

import __spark_entry__ as entry
from tests.oracle_check import connect, differences

SF_DIR = "/root/testdata/sf0.001"
CHECKED = [
    "a01_missing_percent", "a05_rate_by_demographics", "a06_histograms", "a07_top_values",
    "a11_correlations", "a18_describe_encounters", "a21_medians", "a22_modes",
    "d02_split", "d04_folds", "e02_one_hot", "f23_feature_table", "g09_metric_table",
    "g10_roc_points", "g13_calibration", "h09_whole_audit", "k04_top_contributions",
    "p07_cleaning_audit", "p08_clean", "s01_typed_csv_scan", "s03_lookup_file",
    "s04_decode_ids", "v04_backfill", "v07_cohort_view", "w03_cumulative_counts",
    "a23_distinct_values", "d03_missing_label", "d06_oversample", "e06_encoder_kinds",
    "e08b_logistic_properties", "e09b_coefficient_properties", "e12b_score_properties",
    "k02b_top_coefficient_properties", "j04_split_overlap", "j05_alignment",
    "j06_nearest_neighbours", "s09_sanity_summary", "u03_append_synthetic", "w05_rank_order",
    "x01b_attribution_properties", "v06c_stream_scores", "x06_representative_cases",
    "a17c_sketch_errors", "a21c_quantile_errors", "h01b_bucketed_demographics",
    "j02b_bucketed_join", "s10b_bucketed_split",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []


@pytest.mark.parametrize("name, columns", [
    ("e08_logistic_regression", {"auroc", "auprc", "intercept"}),
    ("e09_coefficients", {"feature", "coefficient"}),
    ("e10_boosted_trees", {"auroc", "auprc", "rounds"}), ("e11_staged_precision", {"round", "auprc"}),
    ("e12_scores", {"row_id", "model", "label", "score"}),
    ("e17_generic_names", {"feature", "importance"}), ("g15_evaluation_suite", {"name", "model", "row"}),
    ("k02_top_coefficients", {"feature", "coefficient"}), ("s17_run_log", {"run", "key", "value"}),
    ("v06_score_profiles", {"row_id", "score", "risk_band"}),
    ("x01_tree_attributions", {"row_id", "feature", "value", "impact"}),
])
def test_model_queries_return_their_values(spark, name, columns):
    rows = entry.queries()[name](spark, SF_DIR).collect()
    assert rows and columns <= set(rows[0].asDict())
    assert all(rows[0][c] is not None for c in columns)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"value", "rate", "n"}


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
