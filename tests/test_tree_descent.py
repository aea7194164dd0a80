"""Rows go down the trees instead of being held against every leaf."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array

from caretide.operators import boosting as B, tree_attribution as TA


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 6)).round(1)
    label = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=800) > 0).astype(int)
    rows = spark.createDataFrame(
        list(zip(label.tolist(), x.tolist())), "label int, x array<double>"
    ).select("label", array_to_vector("x").alias("features"))
    return x, rows, B.boosted({"max_depth": 4, "n_estimators": 6}).fit(rows)


def test_descent_ends_in_the_leaf_whose_box_holds_the_row(spark, fitted):
    x, rows, model = fitted
    x = np.concatenate([x, np.full((1, 6), np.nan), np.full((1, 6), np.inf)])
    margins = TA.tree_margins(x, TA.collect_nodes(spark, model))
    want = np.zeros_like(margins)
    for g in TA.collect_leaves(spark, model):
        hit = TA._reached(x, g, slice(None)).all(axis=2)
        for leaf, tree in enumerate(g.tree):
            want[hit[:, leaf], tree] += g.value[leaf]
    assert (margins == want).all()
    odds = [r[0] for r in model.transform(rows).select(vector_to_array("rawPrediction")[1]).collect()]
    assert margins[:-2].sum(axis=1) == pytest.approx([2 * v for v in odds])


def test_a_step_of_a_row_does_not_depend_on_the_number_of_leaves():
    """Three hundred trees of 128 leaves: earlier 38,400 boxes were tried for every row."""
    inner = np.arange(127)
    one = {"feature": np.r_[inner % 5, np.zeros(128, int)], "cut": np.r_[inner / 127, np.zeros(128)],
           "left": np.r_[2 * inner + 1, np.arange(127, 255)],
           "right": np.r_[2 * inner + 2, np.arange(127, 255)], "value": np.arange(255.0)}
    trees = [{k: v + (i * 255 if k in ("left", "right") else 0) for k, v in one.items()}
             for i in range(300)]
    nodes = TA.Nodes(roots=np.arange(300) * 255, **{
        k: np.concatenate([t[k] for t in trees]) for k in one})
    steps = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            steps.append(1)
            return super().__getitem__(at)

    x = np.random.default_rng(0).random((50, 5)).view(Counted)
    margins = TA.tree_margins(x, nodes)
    assert margins.shape == (50, 300) and (margins >= 127).all()
    assert len(steps) == 300 * 8  # seven levels, and one step that moves no row


def test_impacts_by_leaf_are_those_of_the_formula(spark, fitted):
    x, _, model = fitted
    groups = TA.collect_leaves(spark, model)
    tabled, by_row = TA.row_impacts(x, groups), TA.row_impacts(x, groups, [None] * len(groups))
    assert tabled.flags.c_contiguous and tabled == pytest.approx(by_row, abs=1e-9)
    odds = TA.tree_margins(x, TA.collect_nodes(spark, model)).sum(axis=1)
    assert tabled.sum(axis=1) + TA.base_value(groups) == pytest.approx(odds)
