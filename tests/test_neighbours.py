"""The two levels of trees below the neighbour search, against brute force."""

import numpy as np
import pytest

from caretide.operators import oversample as O

NUMERIC, WIDTH = 14, 31


def _rows(n, seed=11, hot=0.0):
    """Rows of 31 features: numbers that follow two hidden ones, and rare nominal values."""
    rng = np.random.default_rng(seed)
    hidden = rng.uniform(0, 100, (n, 2))
    x = np.zeros((n, WIDTH))
    x[:, :NUMERIC] = (hidden @ rng.uniform(0.2, 1, (2, NUMERIC))).round(2)
    x[:, NUMERIC:] = rng.random((n, WIDTH - NUMERIC)) < 0.01
    x[: int(n * hot)] = x[0]
    return x


def _table(spark, x):
    rows = [(f"r{i}", [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "row_id string, x array<double>")


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_exact_below_crowded_cells(spark, hot):
    x = _rows(700, hot=hot)
    penalty = np.median(x[:, :NUMERIC].std(axis=0)) ** 2
    gaps = x[:, None, :] - x[None, :, :]
    d = (gaps[:, :, :NUMERIC] ** 2).sum(axis=2) + penalty * (gaps[:, :, NUMERIC:] != 0).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    found = O.nearest_neighbours(_table(spark, x), NUMERIC, 5, block_rows=24, max_leaves=3).collect()
    assert len(found) == 5 * len(x)
    for r in found:
        i, j = int(r["row_id"][1:]), int(r["neighbour"][1:])
        want = np.partition(d[i], r["place"] - 1)[r["place"] - 1]
        assert r["distance"] == pytest.approx(want) and d[i, j] == pytest.approx(want)
        assert r["nx"] == list(x[j])
    assert len({(r["row_id"], r["neighbour"]) for r in found}) == len(found)


def test_boxes_grow_with_the_rows(spark):
    """On average a row is compared with less than sixteen blocks of rows, however many there are."""
    compared = {}
    for n in (500, 2000):
        work = O.search_effort(_table(spark, _rows(n)), NUMERIC, 5, block_rows=16, max_leaves=12)
        sizes = [r["compared"] for r in work.collect()]
        assert len(sizes) == n
        compared[n] = np.mean(sizes)
    assert compared[500] < 16 * 16 and compared[2000] < 16 * 16, compared


def test_a_cell_of_copies_has_no_tree_to_grow(spark):
    x = np.repeat(_rows(2), 150, axis=0)
    found = O.nearest_neighbours(_table(spark, x), NUMERIC, 5, block_rows=20, max_leaves=2).collect()
    assert len(found) == 5 * len(x) and {r["distance"] for r in found} == {0.0}
