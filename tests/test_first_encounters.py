"""Columns are derived for the encounters that cleaning keeps, and for no others."""

import datetime as dt

import pytest

from caretide.operators.features import modelling_table
from caretide.plans import tables as T
from caretide.sources.order_view import encounters


def _day(n):
    return None if n is None else dt.date(1995, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def orders_dir(spark, tmp_path_factory):
    """Customers with several orders, some of them terminal, repeated keys, and nulls."""
    path = str(tmp_path_factory.mktemp("orders"))
    orders = [(k, k % 40, _day(k * 13 % 400), f"{1 + k % 5}-X") for k in range(1, 400)]
    # a first order without a day has no label and is not in the view
    orders += [(0, 41, None, "1-X"), (502, 41, _day(2), "1-X"), (501, 42, None, "1-X")]
    orders += [(7, 7, _day(91), "3-X"), (400, 3, None, "1-X"), (401, None, _day(5), "2-X"),
               (None, 8, _day(9), "2-X"), (9, 11, _day(17), "4-X"), (402, 999, _day(3), None)]
    tables = {
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderdate date, "
                           "o_orderpriority string"),
        "customer": ([(c, c % 25) for c in range(60)] + [(5, 5), (None, 1)],
                     "c_custkey bigint, c_nationkey int"),
        "lineitem": ([(k,) for k in range(1, 400, 2) for _ in range(k % 4)] + [(None,)],
                     "l_orderkey bigint"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


def _rows(df):
    return sorted(map(str, df.collect()))


def test_features_are_those_of_the_whole_view(spark, orders_dir):
    whole = _rows(modelling_table(encounters(spark, orders_dir)))
    assert len(whole) > 30 and any("row_id=None" in row for row in whole)
    assert any("row_id='502'" in row for row in whole)
    assert _rows(T.modelling(spark, orders_dir)) == whole


def test_only_chosen_encounters_are_derived(spark, orders_dir):
    n = encounters(spark, orders_dir).count()
    first = T.first_encounters(spark, orders_dir)
    assert first.columns == encounters(spark, orders_dir).columns
    assert first.count() < n / 4


def test_orders_left_out_still_end_the_gap(spark, orders_dir):
    chosen = spark.createDataFrame([("1",), ("2",)], "id string")
    columns = ["encounter_id", "readmitted"]
    some = encounters(spark, orders_dir, columns, chosen)
    whole = encounters(spark, orders_dir, columns).where("encounter_id in ('1', '2')")
    assert _rows(some) == _rows(whole) and some.count() == 2
