"""Stored sketches: merging, errors, and parts without values."""

import pytest
from pyspark.sql import functions as F

from caretide.operators import sketch as K


@pytest.fixture(scope="module")
def rows(spark):
    """A third of all rows lie in one part; values repeat over parts."""
    i = F.col("id")
    return spark.range(60_000, numPartitions=6).select(
        F.when(i % 3 == 0, "hot").otherwise((i % 11).cast("string")).alias("part"),
        (i * 7919 % 25_013).cast("string").alias("who"),
        F.pow(i * 31 % 60_000 / 600.0, 2).alias("x"),
        F.when(i % 5 == 0, float("nan")).when(i % 5 == 1, None).otherwise(i % 4.0).alias("y"))


def test_merged_distinct_counts(rows):
    sketches = K.distinct_sketches(rows, ["who", "x"], "part")
    parts = {(r["part"], r["attribute"]): r["n"] for r in sketches.collect()}
    assert len(parts) == 24 and parts["hot", "who"] == 20_000
    found = {r["attribute"]: r for r in K.distinct_estimates(sketches).collect()}
    assert found["who"]["n"] == 60_000
    assert found["who"]["distinct"] == pytest.approx(25_013, rel=K.DISTINCT_ERROR)
    assert found["x"]["distinct"] == pytest.approx(60_000, rel=K.DISTINCT_ERROR)
    some = K.distinct_estimates(sketches.where("part = '1'")).where("attribute = 'who'").first()
    exact = rows.where("part = '1'").select("who").distinct().count()
    assert some["distinct"] == pytest.approx(exact, rel=K.DISTINCT_ERROR)


def test_merged_quantiles(rows):
    sketches = K.quantile_sketches(rows, ["x", "y"], "part")
    found = K.quantile_estimates(sketches, [0.0, 0.1, 0.5, 0.99])
    errors = K.rank_errors(rows, found).collect()
    assert len(errors) == 8
    assert all(r["rank_error"] <= K.RANK_ERROR and r["n_equal"] > 0 for r in errors)
    assert {r["n"] for r in found.where("attribute = 'y'").collect()} == {36_000}


def test_errors_are_seen(spark, rows):
    wrong = spark.createDataFrame([("x", 0.5, 100.0)], "attribute string, share double, value double")
    assert K.rank_errors(rows, wrong).first()["rank_error"] == pytest.approx(0.4, abs=0.01)


def test_parts_without_values(spark):
    df = spark.createDataFrame(
        [("a", None, None), ("a", None, float("nan")), (None, "k", 2.0), ("b", "k", 1.0)],
        "part string, who string, x double")
    distinct = K.distinct_sketches(df, ["who"], "part")
    assert {(r["part"], r["n"]) for r in distinct.collect()} == {("a", 0), (None, 1), ("b", 1)}
    assert K.distinct_estimates(distinct).first()["distinct"] == 1
    assert K.distinct_estimates(distinct.where("part = 'a'")).first()["distinct"] == 0
    numbers = K.quantile_sketches(df, ["x"], "part")
    assert K.quantile_estimates(numbers).first()["value"] in (1.0, 2.0)
    empty = K.quantile_estimates(numbers.where("part = 'a'"))
    assert empty.first()["value"] is None
    assert K.rank_errors(df, empty).count() == 0
    assert K.distinct_estimates(K.distinct_sketches(df.where("1 = 0"), ["who"], "part")).count() == 0
