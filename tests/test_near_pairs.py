"""Pairs told apart by a product of matrices are those that an exact comparison finds."""

import time

import numpy as np
import pytest

from caretide.operators import oversample as O

NUMERIC, PENALTY = 3, 2.3


def _by_hand(x, ids, y, others, k, reach):
    found = []
    for i in range(len(x)):
        gaps = x[i] - y
        d = (gaps[:, :NUMERIC] ** 2).sum(axis=1) + PENALTY * (gaps[:, NUMERIC:] != 0).sum(axis=1)
        near = [(d[j], others[j]) for j in range(len(y)) if others[j] != ids[i] and d[j] <= reach[i]]
        found.append(sorted(near)[:k])
    return found


@pytest.mark.parametrize("shift, repeats", [(0.0, 1), (1e7, 1), (0.0, 9)])
def test_rough_distances_lose_no_pair(shift, repeats):
    rng = np.random.default_rng(5)
    x, y = (rng.integers(0, 6, (n, 7)).astype(float) for n in (70, 300))
    x[:, 4:] %= 2
    y[:, 4:] %= 2
    x[:, 0] += shift
    y[:, 0] += shift
    ids = np.array([f"r{i}" for i in range(70)], dtype=object)
    others = np.array([f"r{i // repeats}" for i in range(300)], dtype=object)
    radius = rng.uniform(0, 4, 70)
    for reach in (None, radius):
        i, j, d = O._nearest(x, ids, y, others, 5, NUMERIC, PENALTY, reach)
        limits = np.full(70, np.inf) if reach is None else reach**2 * (1 + 1e-9)
        for row, want in enumerate(_by_hand(x, ids, y, others, 5, limits)):
            got = [(d[n], others[j[n]]) for n in np.flatnonzero(i == row)]
            assert [v for _, v in got] == [v for _, v in want]
            assert [v for v, _ in got] == pytest.approx([v for v, _ in want])


def test_values_that_are_no_numbers_are_compared_exactly():
    x = np.array([[0.0, 0, 0, 1], [1, 0, 0, np.nan], [np.nan, 0, 0, 1], [3, 0, 0, 1]])
    ids = np.array(list("abcd"), dtype=object)
    i, j, d = O._nearest(x, ids, x, ids, 2, NUMERIC, PENALTY)
    assert [(ids[a], ids[b], c) for a, b, c in zip(i, j, d)][:2] == [
        ("a", "b", pytest.approx(1 + PENALTY)), ("a", "d", pytest.approx(9))]
    assert not (i == 2).any() and not (j == 2).any()


def test_a_search_in_a_far_block_returns_no_rows_and_costs_little():
    """A block that holds nothing within the radius is passed by a product alone."""
    rng = np.random.default_rng(7)
    x, y = rng.normal(0, 10, (2048, 31)), rng.normal(0, 10, (4096, 31))
    ids, others = (np.array([f"{c}{i}" for i in range(n)], dtype=object)
                   for c, n in (("a", 2048), ("b", 4096)))
    began = time.process_time()
    i, _, _ = O._nearest(x, ids, y, others, 5, 31, PENALTY, np.full(2048, 1.0))
    assert not len(i) and time.process_time() - began < 2.0
