import hashlib

import pytest
from pyspark.sql import functions as F

from caretide import schema as S
from caretide.operators import split as D


@pytest.fixture(scope="module")
def labeled(spark):
    rows = [(f"r{i}", int(i % 9 == 0)) for i in range(2000)]
    return spark.createDataFrame(rows, "row_id string, readmitted_30day int")


def test_split_is_exact_and_stratified(spark, labeled):
    rows = D.split_data(labeled).collect()
    assert len(rows) == 2000 and len({r["row_id"] for r in rows}) == 2000
    positives = 223
    for name, share in (("test", .15), ("val", .15), ("train", .70)):
        part = [r for r in rows if r["split"] == name]
        assert abs(len(part) / 2000 - share) < 0.002
        rate = sum(r["readmitted_30day"] for r in part) / len(part)
        assert abs(rate - positives / 2000) < 0.002


def test_split_does_not_depend_on_partitioning(labeled):
    a = {r[0]: r[2] for r in D.split_data(labeled.repartition(1)).collect()}
    b = {r[0]: r[2] for r in D.split_data(labeled.repartition(13)).collect()}
    assert a == b
    other = {r[0]: r[2] for r in D.split_data(labeled, seed=7).collect()}
    assert a != other


def test_split_adds_no_shuffle(labeled):
    plan = D.split_data(labeled)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_folds(labeled):
    rows = D.fold_data(labeled).collect()
    for label in (0, 1):
        sizes = [sum(r["fold"] == f and r["readmitted_30day"] == label for r in rows) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == (223 if label else 1777)


@pytest.mark.parametrize("n", [1, 4, 6, 101])
def test_folds_of_any_size_differ_by_one(spark, n):
    df = spark.createDataFrame([(str(i), 1) for i in range(n)], "row_id string, readmitted_30day int")
    folds = [r["fold"] for r in D.fold_data(df).collect()]
    sizes = [folds.count(f) for f in range(5)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_large_prefixes_are_counted_further(labeled, monkeypatch):
    want = {r[0]: r[2] for r in D.split_data(labeled).collect()}
    monkeypatch.setattr(D, "_DIGITS", 1)
    monkeypatch.setattr(D, "_SORTED", 3)
    assert {r[0]: r[2] for r in D.split_data(labeled).collect()} == want


def test_ranks(labeled):
    rows = D.ranked(labeled).collect()
    for label in (0, 1):
        own = [(r.row_id, r.place) for r in rows if r["readmitted_30day"] == label]
        order = sorted(own, key=lambda r: hashlib.md5(f"{S.SEED}:{r[0]}".encode()).hexdigest())
        assert [p for _, p in order] == list(range(1, len(own) + 1))


def test_overlap_counts(labeled):
    split = D.split_data(labeled).select("row_id", "split")
    twice = split.union(split.where("split = 'test'").withColumn("split", F.lit("val")))
    got = {(r.split_a, r.split_b): r.n for r in D.overlap_counts(twice).collect()}
    assert got == {("test", "val"): split.where("split = 'test'").count()}


def test_report_overlap_and_weights(labeled):
    split = D.split_data(labeled)
    assert D.split_overlap(split).count() == 0
    twice = split.union(split.withColumn("split", F.lit("other")))
    assert D.split_overlap(twice).count() == 2000
    weights = {r[0]: r["weight"] for r in D.class_weights(labeled).collect()}
    assert weights[1] == pytest.approx(2000 / (2 * 223))


def test_missing_label(spark):
    with pytest.raises(ValueError, match="readmitted_30day"):
        D.split_data(spark.createDataFrame([("a",)], "row_id string"))


def test_tiny_table(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", None)], "row_id string, readmitted_30day int")
    got = {r["row_id"]: r["split"] for r in D.split_data(df).collect()}
    assert got["c"] is None and got["a"] == got["b"] == "test"
