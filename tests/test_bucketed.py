"""Tables in buckets of the row, and what their joins do not move."""

import pytest
from pyspark.sql import functions as F

from caretide.operators import audit as H
from caretide.sources.bucketed import bucketed, forget, read_bucketed, write_bucketed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def tables(spark):
    ids = spark.range(500).select(F.col("id").cast("string").alias("row_id"), "id")
    people = ids.select(
        "row_id", F.when(F.col("id") % 7 == 0, "test").otherwise("train").alias("split"),
        F.concat(F.lit("r"), F.col("id") % 3).alias("race"), F.lit("x").alias("gender"),
        F.lit("[0-10)").alias("age"))
    scored = ids.where("id % 2 = 0").select(
        "row_id", F.lit("m").alias("model"), (F.col("id") % 2).cast("int").alias("label"),
        (F.col("id") / 500).alias("score"))
    return people, scored


def test_join_moves_nothing(no_broadcast, tables, tmp_path):
    people, scored = tables
    plain = H.attach_demographics(scored, people)
    left = bucketed(people, str(tmp_path / "people"), buckets=6)
    right = bucketed(scored, str(tmp_path / "scores"), buckets=6)
    joined = H.attach_demographics(right, left)
    assert "Exchange" in _plan(plain) and "Exchange" not in _plan(joined)
    assert sorted(map(tuple, joined.select(plain.columns).collect())) == sorted(
        map(tuple, plain.collect()))
    # groupings by the row stay in place too
    assert "Exchange" not in _plan(left.groupBy("row_id").count())


def test_another_session_opens_the_folder(no_broadcast, tables, tmp_path):
    people, scored = tables
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    write_bucketed(people, a, buckets=4), write_bucketed(scored, b, buckets=4)
    other = no_broadcast.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    forget(no_broadcast, a), forget(no_broadcast, b)
    joined = read_bucketed(other, b).join(read_bucketed(other, a), "row_id")
    assert "Exchange" not in _plan(joined) and joined.count() == 250
    files = [p for p in (tmp_path / "a" / "rows").iterdir() if p.suffix == ".parquet"]
    assert len(files) == 4  # one a bucket


def test_a_table_is_replaced_with_its_layout(spark, tables, tmp_path):
    people, _ = tables
    path = str(tmp_path / "t")
    write_bucketed(people, path, buckets=3)
    again = bucketed(people.where("split = 'test'").drop("age"), path, buckets=5)
    assert again.columns == ["row_id", "split", "race", "gender"] and again.count() == 72


def test_null_keys_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "row_id string, `odd name` int")
    assert sorted(r[1] for r in bucketed(rows, str(tmp_path / "n"), buckets=2).collect()) == [1, 2, 3]
    assert bucketed(rows.where("1 = 0"), str(tmp_path / "e"), buckets=2).count() == 0
    with pytest.raises(ValueError, match="buckets of 'nothing'"):
        write_bucketed(rows, str(tmp_path / "x"), key="nothing")
