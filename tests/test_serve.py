import pytest
from pyspark.sql import functions as F

from caretide import schema as S
from caretide.operators import attribute as X, serve as V
from caretide.operators.encode import prepare
from caretide.operators.models import fit_logistic, serving_pipeline
from caretide.sources import sinks
from caretide.streaming.scoring import score_profiles, write_stream
from tests.test_models import modelling  # noqa: F401 - fixture


def test_defaults(spark):
    df = spark.createDataFrame(
        [(1, "Caucasian", "Male", None), (5, "AfricanAmerican", "Female", None),
         (9, "Caucasian", "Female", None)],
        "time_in_hospital int, race string, gender string, empty string",
    )
    got = V.defaults_dict(V.form_defaults(df))
    assert got == {"time_in_hospital": 5.0, "race": "Caucasian", "gender": "Female", "empty": None}


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert V.defaults_dict(V.form_defaults(df)) == {"v": "a"}


def test_options(spark):
    rows = [("Emergency", 7, "Circulatory", "Home", "Female", "InternalMedicine", "Caucasian"),
            ("Urgent", 1, "Respiratory", "SNF", "Male", "Cardiology", "AfricanAmerican"),
            ("Emergency", 10, "Circulatory", "Home", "Female", "Cardiology", "Caucasian")]
    df = spark.createDataFrame(rows, ", ".join(
        f"{c} {'int' if c == 'admission_source_id' else 'string'}" for c in S.FORM_OPTIONS))
    got = {}
    for r in V.form_options(df).orderBy("attribute", "position").collect():
        got.setdefault(r["attribute"], []).append(r["value"])
    assert got["admission_category"] == ["Emergency", "Urgent"]
    assert got["admission_source_id"] == ["1", "7", "10"]
    assert got["medical_specialty_grouped"] == ["Cardiology", "InternalMedicine"]


def test_waterfall_ends_at_the_margin(spark):
    long = spark.createDataFrame(
        [("1", "a", 1.0, 0.5), ("1", "b", 2.0, -2.0), ("1", "c", 0.0, 0.1), ("2", "a", 1.0, 1.0)],
        "row_id string, feature string, value double, impact double",
    )
    rows = X.waterfall(long, spark.createDataFrame([("1",)], "row_id string"), -1.0)
    got = [(r["feature"], r["running"]) for r in rows.orderBy("step").collect()]
    assert [g[0] for g in got] == ["c", "a", "b"]
    assert [g[1] for g in got] == pytest.approx([-0.9, -0.4, -2.4])


def test_cases_use_a_strict_cut(spark):
    rows = [("10", 1, 0.1), ("9", 1, 0.2), ("2", 0, 0.1), ("11", 0, 0.05), ("3", 0, 0.4)]
    df = spark.createDataFrame(rows, "row_id string, label int, score double")
    got = {r["outcome"]: r["row_id"] for r in X.representative_cases(df).collect()}
    assert got == {"TP": "9", "TN": "2", "FP": "3"}


def test_stream_scores_like_batch(spark, modelling, tmp_path):  # noqa: F811
    prepared = prepare(modelling, "lr")
    pipeline = serving_pipeline(prepared, fit_logistic(prepared.train))
    features = modelling.drop(S.LABEL)
    defaults = V.defaults_dict(V.form_defaults(features.drop("row_id")))
    partial = features.drop("polypharmacy_score").withColumn(
        "race", F.when(F.col("row_id").cast("int") % 2 == 0, F.col("race"))
    )
    batch = {r["row_id"]: tuple(r) for r in score_profiles(partial, defaults, pipeline, 0.5).collect()}
    assert len(batch) == 1200
    source = str(tmp_path / "in")
    partial.write.parquet(source)
    stream = spark.readStream.schema(partial.schema).parquet(source)
    out = score_profiles(stream, defaults, pipeline, 0.5)
    query = write_stream(out, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["row_id"]: tuple(r) for r in rows} == batch


def test_bundle_needs_every_part(spark, tmp_path):
    with pytest.raises(ValueError, match="threshold"):
        sinks.save_bundle({"cohort_X": spark.range(1)}, str(tmp_path / "bundle"))
    with pytest.raises(ValueError, match="lacks"):
        sinks.load_bundle(spark, str(tmp_path / "bundle"))


def test_stored_threshold_falls_back(spark, tmp_path):
    scored = spark.createDataFrame(
        [("1", "m", 1, 0.9), ("2", "m", 0, 0.2)],
        "row_id string, model string, label int, score double",
    )
    missing = str(tmp_path / "none")
    assert sinks.threshold_or_compute(spark, missing, "Boosted", scored) == 0.9


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    sinks.log_run(spark, path, "a", {"depth": 3}, {"auroc": 0.6})
    sinks.log_run(spark, path, "b", metrics={"auroc": 0.7})
    assert sinks.read_runs(spark, path).count() == 3
