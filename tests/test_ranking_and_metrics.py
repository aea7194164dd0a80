import math

import numpy as np
import pytest

from caretide.operators import audit as H, evaluate as E
from caretide.operators.ranking import exact_quantiles, score_curve


def scored(spark, pairs, model="m"):
    rows = [(str(i), model, int(y), float(p)) for i, (y, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, "row_id string, model string, label int, score double")


@pytest.fixture(scope="module")
def tied(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 400)
    p = np.round(rng.random(400) * 0.8 + 0.2 * y, 2)
    p[:130] = 0.5  # a third of all rows share one score
    return y, p, scored(spark, zip(y, p))


def brute(y, p):
    pos, neg = p[y == 1], p[y == 0]
    auroc = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    ap, recall, cost = 0.0, 0.0, {1.0000000000000002: 5.0 * len(pos)}
    for t in sorted(set(p), reverse=True):
        tp, fp = (pos >= t).sum(), (neg >= t).sum()
        ap += (tp / len(pos) - recall) * tp / (tp + fp)
        recall = tp / len(pos)
        cost[t] = 5.0 * (len(pos) - tp) + fp
    return auroc, ap, min(cost, key=lambda t: (cost[t], t))


def test_metrics_match_brute_force(tied):
    y, p, df = tied
    auroc, ap, threshold = brute(y, p)
    row = E.metric_table(df).first()
    assert row["AUROC"] == pytest.approx(auroc)
    assert row["AUPRC"] == pytest.approx(ap)
    assert row["Opt_Threshold"] == threshold
    assert row["Brier"] == pytest.approx(np.mean((p - y) ** 2))
    said = p >= threshold
    assert row["Sensitivity"] == pytest.approx(said[y == 1].mean())
    assert row["Specificity"] == pytest.approx((~said)[y == 0].mean())
    assert row["PPV"] == pytest.approx(y[said].mean())


@pytest.mark.parametrize("ranges", [2, 7, 1024])
def test_ranges_give_the_same_curve(tied, ranges):
    _, _, df = tied
    plain = sorted(map(tuple, score_curve(df).collect()))
    split = score_curve(df, ranges=ranges).select(
        "model", "score", "pos", "neg", "tp", "fp", "pos_total", "neg_total", "next_pos", "next_neg"
    )
    assert sorted(map(tuple, split.collect()), key=str) == sorted(plain, key=str)


def test_roc_leaves_out_straight_runs(tied):
    y, p, df = tied
    points = sorted((r["fpr"], r["tpr"]) for r in E.roc_points(df).collect())
    every = sorted((r["fpr"], r["tpr"]) for r in E.roc_points(df, drop_collinear=False).collect())
    assert set(points) <= set(every) and len(points) < len(every)
    area = lambda ps: sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(ps, ps[1:]))
    assert area(points) == pytest.approx(area(every)) == pytest.approx(brute(y, p)[0])


def test_threshold_cases(spark):
    a = scored(spark, [(0, .05), (0, .10), (0, .30), (1, .35), (1, .80), (1, .95)])
    assert E.threshold_of(a) == 0.35
    b = scored(spark, [(0, .90), (0, .80), (0, .70), (0, .60), (0, .55), (0, .51), (1, .50)])
    assert E.threshold_of(b) == math.nextafter(1.0, 2.0)


def test_one_class(spark):
    row = E.metric_table(scored(spark, [(0, .1), (0, .2)])).first()
    assert row["AUROC"] is None and row["Sensitivity"] == 0.0 and row["F1"] == 0.0


def test_bins(spark):
    df = scored(spark, [(1, 0.1), (0, 0.3), (0, 1.0), (0, 0.0)])
    calibrated = {r["bin"]: r["n"] for r in E.calibration(df).collect()}
    assert calibrated == {0: 2, 2: 1, 9: 1}  # closed on the right
    counted = {r["bin"]: r["n"] for r in E.score_histogram(df).collect()}
    assert counted == {0: 1, 1: 1, 2: 1, 9: 1}  # closed on the left


def test_pr_curve_ends_at_precision_one(spark):
    points = E.pr_points(scored(spark, [(1, .9), (0, .4)])).collect()
    assert (1.0, 0.0, None) in {(r["precision"], r["recall"], r["threshold"]) for r in points}


def test_alignment(spark):
    a = scored(spark, [(1, .1), (0, .2), (1, .3)])
    b = scored(spark, [(1, .5), (1, .5)])
    row = E.alignment(a, b).first()
    assert row.asDict() == {"matched": 2, "only_left": 1, "only_right": 0, "label_mismatch": 1}
    with pytest.raises(ValueError, match="align"):
        E.check_alignment(a, b)


@pytest.mark.parametrize("ranges", [1, 16])
def test_quantiles_are_exact(spark, ranges):
    rng = np.random.default_rng(1)
    values = np.concatenate([np.full(100, 7.0), rng.normal(size=201) * 50])
    df = spark.createDataFrame([(float(v), i % 4 or None) for i, v in enumerate(values)], "a double, b int")
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {
        (r["column"], r["share"]): r["value"]
        for r in exact_quantiles(df, ["a", "b"], shares, ranges=ranges).collect()
    }
    known = [i % 4 for i in range(len(values)) if i % 4]
    for s in shares:
        assert got[("a", s)] == pytest.approx(np.quantile(values, s))
        assert got[("b", s)] == pytest.approx(np.quantile(known, s))


def test_audit(spark):
    rows = [(str(i), i % 2, (i % 10) / 10, "x" if i < 60 else None, "F", "[0-10)") for i in range(120)]
    rows += [(f"b{i}", 0, 0.9, "y", "M", None) for i in range(5)]
    df = spark.createDataFrame(
        rows, "row_id string, label int, score double, race string, gender string, age string"
    )
    audit = {(r["Attribute"], r["Subgroup"]): r for r in H.audit_table(df, 0.5).collect()}
    assert set(audit) == {("Race", "x"), ("Race", "y"), ("Gender", "F"), ("Gender", "M"), ("Age", "[0-10)")}
    one = audit[("Race", "y")]
    assert one["N"] == 5 and one["AUROC"] is None and one["TPR"] == 0.0 and one["FPR"] == 1.0
    pairs = [(i % 2, (i % 10) / 10) for i in range(60)]
    y, p = (np.array(v) for v in zip(*pairs))
    assert audit[("Race", "x")]["AUROC"] == pytest.approx(brute(y, p)[0])
    without_age = H.audit_table(df.drop("age"), 0.5)
    assert without_age.where("Attribute = 'Age'").count() == 0


ODD = [(1, .9), (0, None), (1, float("nan")), (0, .9), (1, float("inf")), (0, float("-inf")),
       (1, .2), (0, .2), (None, .9), (1, .2)]


def odd_scores(spark):
    rows = [(str(i), "m", y, p) for i, (y, p) in enumerate(ODD)]
    return spark.createDataFrame(rows, "row_id string, model string, label int, score double")


def test_null_and_nan_scores_take_no_part_whatever_the_ranges(spark):
    df = odd_scores(spark)
    want = [("m", float("inf"), 1, 0, 1, 0), ("m", .9, 1, 1, 2, 1), ("m", .2, 2, 1, 4, 2),
            ("m", float("-inf"), 0, 1, 4, 3)]
    for ranges in (1, 2, 3, 50):
        curve = score_curve(df, ranges=ranges).collect()
        got = [(r.model, r.score, r.pos, r.neg, r.tp, r.fp) for r in curve]
        assert sorted(got, key=lambda r: -r[1]) == want
        assert {(r.pos_total, r.neg_total) for r in curve} == {(4, 3)}
    known = np.array([(y, p) for y, p in ODD if y is not None and p is not None and p == p])
    auroc = brute(known[:, 0].astype(int), known[:, 1])[0]
    assert E.metric_table(df).first()["AUROC"] == pytest.approx(auroc)
    assert E.calibration(df).agg({"n": "sum"}).first()[0] == 8


def test_median_of_values_with_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "a double")
    for ranges in (1, 4):
        assert exact_quantiles(df, ["a"], ranges=ranges).first()["value"] == 1.5


def test_models_must_align(spark):
    a = scored(spark, [(1, .1), (0, .2)])
    E.check_models_align(a.unionByName(scored(spark, [(1, .5), (0, .5)], "n")))
    with pytest.raises(ValueError, match="align"):
        E.check_models_align(a.unionByName(scored(spark, [(1, .5), (1, .5)], "n")))
    with pytest.raises(ValueError, match="align"):
        E.check_models_align(a.unionByName(scored(spark, [(1, .5)], "n")))
