"""Fits that go on: the same trees as in one go, after losses too."""

import re

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from caretide.operators import boosting as B, models as M
from caretide.operators.encode import fill_numeric, prepare
from caretide.plans import tables as T
from caretide.session import folder_names, materialize, scratch_path

# every test states its blocks: by default one opening would be enough
SMALL = {"max_depth": 3, "n_estimators": 9, "subsample": 1.0, "colsample": 1.0}


@pytest.fixture(scope="module")
def prepared(spark):
    rows = materialize(fill_numeric(T.modelling(spark, "/root/testdata/sf0.001")), "boost-rows")
    return prepare(rows, "xgb")


def trees(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.trees]


def test_continued_fit_has_the_trees_of_the_classifier(spark):
    """Over continuous features and large leaves, so that no two splits gain the same."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    label = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=3000) > 0).astype(int)
    rows = spark.createDataFrame(
        list(zip(label.tolist(), x.tolist())), "label int, x array<double>"
    ).select("label", array_to_vector("x").alias("features"))
    rows = materialize(rows.coalesce(2), "continuous")
    settings = {**SMALL, "min_child_weight": 150}
    whole = B.boosted(settings).fit(rows)
    start = B.first_trees(whole, 4)
    more = B.grow(B._with_margin(rows, start), settings, 4, 5, 42, whole.numFeatures)
    joined = B.ensemble([*start.trees, *more.trees], [*start.treeWeights, *more.treeWeights], 5)
    assert list(joined.treeWeights) == list(whole.treeWeights)
    rule = re.compile(r"(If|Else) \(feature \d+ (<=|>) [-.\dE]+\)")
    for a, b in zip(joined.trees, whole.trees):
        assert rule.findall(a.toDebugString) and a.numNodes == b.numNodes
        assert [m.group() for m in rule.finditer(a.toDebugString)] == [
            m.group() for m in rule.finditer(b.toDebugString)]
    scores = [[r[0] for r in m.transform(rows).select(vector_to_array("probability")[1]).collect()]
              for m in (joined, whole)]
    assert scores[0] == pytest.approx(scores[1], abs=1e-6)


@pytest.mark.parametrize("parameters", [SMALL, {**SMALL, "subsample": 0.7, "colsample": 0.6}])
def test_blocks_change_nothing(prepared, parameters):
    held = prepared.part("val")
    one = B.fit(prepared.train, held, parameters, 100, opening=1, block=20)
    many = B.fit(prepared.train, held, parameters, 100, opening=1, block=3)
    assert one.precision.keys() == many.precision.keys() == set(range(1, 10))
    if parameters is SMALL:
        assert trees(one.model) == trees(many.model)
        assert one.precision == pytest.approx(many.precision)


def test_precision_is_that_of_the_cut_models(prepared):
    held = prepared.part("val")
    found = B.fit(prepared.train, held, SMALL, 100, opening=3, block=4)
    for n in (1, 3, found.model.getNumTrees):
        cut = M.score(B.first_trees(found.model, n), held, "m")
        assert M.E.quick_metrics(cut).first()["auprc"] == pytest.approx(found.precision[n])
    best, _ = B.decide(found.precision, 100)
    assert best == found.model.getNumTrees


def test_patience():
    assert B.decide({1: 0.2, 2: 0.3, 3: 0.3, 4: 0.1}, 2) == (2, True)
    assert B.decide({1: 0.2, 2: 0.3, 3: 0.1}, 2) == (2, False)
    assert B.decide({1: None, 2: None, 3: None}, 2) == (1, True)


def test_fit_goes_on_where_it_was_lost(spark, prepared, monkeypatch):
    held, folder = prepared.part("val"), scratch_path(spark, "fit")
    whole = B.fit(prepared.train, held, SMALL, 100, opening=2, block=2)
    grown, grow = [], B.grow

    def lost(rows, parameters, first, *rest):
        if first == 6:
            raise RuntimeError("lost")
        grown.append(first)
        return grow(rows, parameters, first, *rest)

    monkeypatch.setattr(B, "grow", lost)
    with pytest.raises(RuntimeError):
        B.fit(prepared.train, held, SMALL, 100, folder=folder, opening=2, block=2)
    assert grown == [2, 4]
    # a block without measurements is not whole
    names = folder_names(spark, folder)
    spark.range(1).write.parquet(f"{folder}/8/train")
    monkeypatch.setattr(B, "grow", lambda *a: grown.append(a[2]) or grow(*a))
    again = B.fit(prepared.train, held, SMALL, 100, folder=folder, opening=2, block=2)
    assert grown == [2, 4, 6, 8] and "6" in names
    assert trees(again.model) == trees(whole.model)
    with pytest.raises(ValueError, match="other parameters"):
        B.fit(prepared.train, held, {**SMALL, "max_depth": 2}, folder=folder)


def test_search_is_taken_up(spark, prepared, monkeypatch):
    folder = scratch_path(spark, "search")
    monkeypatch.setattr(M, "draw_parameters", lambda n, seed: [
        {**{k: v[1] for k, v in M.S.SEARCH_RANGES.items()}, "n_estimators": 2 + i, "max_depth": 3}
        for i in range(n)])
    fitted, fit = [], M.fit_boosted

    def run(train, held, parameters, *rest, **more):
        if len(fitted) == 2:
            raise RuntimeError("lost")
        fitted.append(parameters["n_estimators"])
        return fit(train, held, parameters, *rest, **more)

    monkeypatch.setattr(M, "fit_boosted", run)
    with pytest.raises(RuntimeError):
        M.search(prepared, trials=4, parallel=1, folder=folder)
    monkeypatch.setattr(M, "fit_boosted", lambda t, h, p, *r, **m: (
        fitted.append(p["n_estimators"]) or fit(t, h, p, *r, **m)))
    found = M.search(prepared, trials=4, parallel=1, folder=folder)
    assert sorted(fitted) == [2, 3, 4, 5] and found.trials.count() == 4
    top = found.trials.orderBy(F.desc("auprc"), "trial").first()
    assert found.best["n_estimators"] == top["n_estimators"]
    with pytest.raises(ValueError, match="another search"):
        monkeypatch.setattr(M, "draw_parameters", lambda n, seed: [
            {k: v[2] for k, v in M.S.SEARCH_RANGES.items()} for _ in range(n)])
        M.search(prepared, trials=4, parallel=1, folder=folder)
