"""Encoders, balancing, fits, attributions and model sinks on small tables."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from caretide import schema as S
from caretide.operators import models as M, oversample as O, tree_attribution as TA
from caretide.operators import evaluate as E
from caretide.operators.encode import EncounterEncoder, feature_names, prepare
from caretide.sources import sinks


@pytest.fixture(scope="module")
def modelling(spark):
    """1200 patients whose label follows from visits and one category."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(1200):
        numbers = {c: int(rng.integers(0, 12)) for c in S.NUMERIC}
        texts = {c: str(rng.choice(["a", "b", "c"])) for c in S.CATEGORICAL}
        texts["admission_source_id"] = int(rng.integers(1, 12))
        flags = {c: int(rng.integers(0, 2)) for c in S.BINARY}
        odds = -3.2 + 0.35 * (numbers["number_inpatient"] - 5) + 1.5 * (texts["race"] == "a")
        label = int(rng.random() < 1 / (1 + np.exp(-odds)))
        rows.append((str(i), *numbers.values(), *texts.values(), *flags.values(), label))
    kinds = ["row_id string"] + [f"{c} int" for c in S.NUMERIC]
    kinds += [f"{c} {'int' if c == 'admission_source_id' else 'string'}" for c in S.CATEGORICAL]
    kinds += [f"{c} int" for c in S.BINARY] + [f"{S.LABEL} int"]
    return spark.createDataFrame(rows, ", ".join(kinds))


@pytest.fixture(scope="module")
def trees(modelling):
    prepared = prepare(modelling, "xgb")
    model = M.fit_boosted(prepared.train, prepared.part("val"), {"max_depth": 4, "n_estimators": 15})
    return prepared, model


# --- encoders -------------------------------------------------------------------


def test_kinds():
    for kind in ("lr", "xgb"):
        assert EncounterEncoder(kind=kind) is not None
    with pytest.raises(ValueError, match="kind"):
        EncounterEncoder(kind="svm")


def test_one_hot_and_scaling(modelling):
    model = EncounterEncoder(kind="lr").fit(modelling)
    names = model.names()
    assert names[0] == "num__time_in_hospital" and names[-1] == "bin__high_utilizer_flag"
    assert "cat__race_a" not in names and "cat__race_b" in names  # the first is dropped
    ids = [n for n in names if n.startswith("cat__admission_source_id_")]
    assert ids == [f"cat__admission_source_id_{i}.0" for i in range(2, 12)]
    encoded = model.encoded(modelling)
    row = encoded.agg(F.avg("num__time_in_hospital"), F.stddev_pop("num__time_in_hospital")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1)
    unknown = model.encoded(modelling.withColumn("race", F.lit("new"))).first()
    assert unknown["cat__race_b"] == unknown["cat__race_c"] == 0.0


def test_ordinal(modelling):
    model = EncounterEncoder(kind="xgb").fit(modelling)
    got = model.encoded(modelling, "race", "admission_source_id")
    pairs = {tuple(r) for r in got.select("race", "cat__race").distinct().collect()}
    assert pairs == {("a", 0.0), ("b", 1.0), ("c", 2.0)}
    ids = {tuple(r) for r in got.select("admission_source_id", "cat__admission_source_id").collect()}
    assert ids == {(i, float(i - 1)) for i in range(1, 12)}
    assert model.encoded(modelling.withColumn("race", F.lit("new"))).first()["cat__race"] == -1.0


@pytest.mark.parametrize("kind", ["lr", "xgb"])
def test_vector_equals_the_columns(modelling, kind):
    """Also for null as a category, unknown values, and a column of one value."""
    train = modelling.withColumns({
        "race": F.when(F.col("row_id") % 5 != 0, F.col("race")), "gender": F.lit("only")})
    model = EncounterEncoder(kind=kind).fit(train)
    odd = train.withColumns({
        "race": F.when(F.col("row_id") % 7 == 0, "new").otherwise(F.col("race")),
        "payer_code" if "payer_code" in train.columns else "gender": F.lit(None).cast("string")})
    wide = model.encoded(odd, "row_id").collect()
    names = model.names()
    want = {r["row_id"]: [r[n] for n in names] for r in wide}
    got = model.transform(odd).select("row_id", vector_to_array("features")).collect()
    assert len(got) == 1200 and all(r[1] == pytest.approx(want[r[0]]) for r in got)


def test_a_million_categories(spark, modelling):
    """Neither fit nor transform brings the values to the driver."""
    rows = spark.range(1_000_000).join(F.broadcast(modelling.limit(1)).drop("row_id", "race"))
    many = rows.withColumn("race", F.concat(F.lit("r"), F.reverse(F.col("id").cast("string"))))
    encoder = EncounterEncoder(kind="xgb").fit(many)
    assert encoder.fitted()["known"]["race"] == 1_000_000 and len(encoder.getOrDefault("state")) < 5_000
    places = encoder.transform(many).select(
        vector_to_array("features")[encoder.names().index("cat__race")].alias("p"))
    assert tuple(places.agg(F.count_distinct("p"), F.min("p"), F.max("p")).first()) == (
        1_000_000, 0.0, 999_999.0)


def test_saved_encoder_brings_its_categories(spark, modelling, tmp_path):
    encoder = EncounterEncoder(kind="lr").fit(modelling)
    encoder.save(str(tmp_path / "encoder"))
    loaded = type(encoder).load(str(tmp_path / "encoder"))
    assert loaded.getOrDefault("path").startswith(str(tmp_path)) and loaded.names() == encoder.names()
    rows = [{r.row_id: r.features for r in e.transform(modelling).collect()} for e in (encoder, loaded)]
    assert rows[0] == rows[1]


def test_many_categories(modelling):
    many = modelling.withColumn("race", F.concat(F.lit("r"), F.col("row_id")))
    model = EncounterEncoder(kind="lr").fit(many)
    names = model.names()
    assert sum(n.startswith("cat__race_") for n in names) == 1199
    row = model.transform(many.where("row_id = '77'")).first()["features"]
    assert len(row) == len(names) and row[names.index("cat__race_r77")] == 1.0
    plan = model.transform(many)._jdf.queryExecution().analyzed().toString()
    assert "r1077" not in plan  # a category is no part of the plan


def test_missing_number(modelling):
    hole = modelling.withColumn("age_midpoint", F.lit(None).cast("int"))
    with pytest.raises(Exception, match="[Nn]ull"):
        EncounterEncoder(kind="lr").fit(modelling).transform(hole).select("features").collect()
    kept = EncounterEncoder(kind="xgb").fit(modelling).transform(hole)
    assert np.isnan(kept.first()["features"][8])


def test_generic_names():
    assert feature_names(["a"], 2) == ["Feature_0", "Feature_1"]
    assert feature_names(["a", "b"], 2) == ["a", "b"]


# --- oversampling ------------------------------------------------------------------


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([
        rng.integers(0, 60, 400), rng.normal(0, 4, 400).round(1), rng.integers(0, 9, 400),
        rng.integers(0, 3, 400), rng.integers(0, 2, 400),
    ]).astype(float)
    x[:150, :3] = x[0, :3]  # one place holds more than a third of the rows
    ids = np.array([f"r{i}" for i in range(400)], dtype=object)
    rows = [(i, [float(v) for v in row]) for i, row in zip(ids, x)]
    return x, ids, spark.createDataFrame(rows, "row_id string, x array<double>")


@pytest.mark.parametrize("block_rows", [25, 2048])
def test_neighbours_are_exact(cloud, block_rows):
    x, ids, df = cloud
    penalty = np.median(x[:, :3].std(axis=0)) ** 2
    gaps = x[:, None, :] - x[None, :, :]
    d = (gaps[:, :, :3] ** 2).sum(axis=2) + penalty * (gaps[:, :, 3:] != 0).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    place = {row_id: i for i, row_id in enumerate(ids)}
    got = {}
    for r in O.nearest_neighbours(df, 3, 5, block_rows).orderBy("place").collect():
        got.setdefault(r["row_id"], []).append(r["neighbour"])
    assert set(got) == set(ids)
    for row_id, near in got.items():
        i = place[row_id]
        assert len(set(near)) == 5 and row_id not in near
        # by distance, as equal ones may differ in the last digit
        found = [d[i, place[n]] for n in near]
        assert found == pytest.approx(np.sort(d[i])[:5])


def test_synthetic_rows(cloud):
    x, ids, df = cloud
    at = {i: row for i, row in zip(ids, x)}
    near = {}
    for r in O.nearest_neighbours(df, 3).collect():
        near.setdefault(r["row_id"], []).append(r["neighbour"])
    made = O.synthesize(df, 1000, 3, 5).collect()
    assert len(made) == 1000 and len({r["row_id"] for r in made}) == 1000
    uses = {}
    for r in made:
        uses[r["base"]] = uses.get(r["base"], 0) + 1
        a, b, y = at[r["base"]], at[r["neighbour"]], np.array(r["x"])
        assert r["neighbour"] in near[r["base"]] and 0 <= r["u"] < 1
        assert y[:3] == pytest.approx(a[:3] + r["u"] * (b[:3] - a[:3]))
        for j in (3, 4):
            values = [at[n][j] for n in near[r["base"]]]
            top = max(values.count(v) for v in values)
            assert y[j] == min(v for v in values if values.count(v) == top)
    assert set(uses.values()) == {2, 3} and len(uses) == 400


def test_balance(trees):
    prepared, _ = trees
    counts = {r["label"]: r["count"] for r in prepared.train.groupBy("label").count().collect()}
    assert counts[0] == counts[1]
    assert prepared.table.where("row_id like '%~%'").count() == 0


def test_too_few_rows(spark):
    df = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "row_id string, x array<double>")
    with pytest.raises(ValueError, match="too few"):
        O.nearest_neighbours(df, 1)
    one = df.select("row_id", F.lit(1).alias("label"), array_to_vector("x").alias("features"))
    with pytest.raises(ValueError, match="two classes"):
        O.oversample(one, 1)


# --- models -----------------------------------------------------------------------


def test_logistic_minimises_the_penalised_loss(modelling):
    prepared = prepare(modelling, "lr")
    model = M.fit_logistic(prepared.train)
    rows = prepared.train.select("label", vector_to_array("features").alias("x")).collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    gradient = x.T @ (weight * (p - y)) + w
    assert np.abs(gradient).max() < 0.05
    table = M.coefficient_table(model, prepared.names).collect()
    sizes = [abs(r["coefficient"]) for r in table]
    assert sizes == sorted(sizes, reverse=True) and len(table) == len(prepared.names)
    scores = M.score(model, prepared.part("test"), "lr")
    assert 0.5 < E.auroc(scores).first()["auroc"] < 1


def test_boosted(trees, tmp_path):
    prepared, model = trees
    scores = M.score(model, prepared.part("test"), "trees")
    assert 0.5 < E.auroc(scores).first()["auroc"] < 1
    path = sinks.save_model(M.serving_pipeline(prepared, model), str(tmp_path / "m"))
    found, loaded = sinks.resolve_model([str(tmp_path / "none"), path])
    assert found == path
    with pytest.raises(FileNotFoundError):
        sinks.resolve_model([str(tmp_path / "none")])
    raw = prepared.table.sparkSession.read.parquet(
        next(iter(prepared.table.inputFiles())).rsplit("/", 1)[0]
    )
    again = loaded.stages[1].transform(raw).select("row_id", vector_to_array("probability")[1])
    assert dict(again.collect()) == dict(
        model.transform(prepared.table).select("row_id", vector_to_array("probability")[1]).collect()
    )


def test_search_and_folds(trees):
    prepared, _ = trees
    drawn = M.draw_parameters(50)
    assert drawn == M.draw_parameters(50)
    for name, (_, low, high) in S.SEARCH_RANGES.items():
        assert all(low <= p[name] <= high for p in drawn)
    folds = M.cross_validate(prepared, {"max_depth": 2, "n_estimators": 3}, folds=3)
    rows = folds.collect()
    assert sorted(r["fold"] for r in rows) == [0, 1, 2]
    summary = E.fold_summary(folds).first()
    assert summary["std_auprc"] == pytest.approx(np.std([r["auprc"] for r in rows]))


def test_stop_by_precision(trees):
    prepared, _ = trees
    train, held = prepared.train, prepared.part("val")
    model = M.fit_boosted(train, held, {"max_depth": 3, "n_estimators": 9}, patience=3)
    assert 1 <= model.getNumTrees <= 9
    best, _ = M.best_round(model, held, 3)
    assert best == model.getNumTrees  # nothing follows the best round


def test_cut_ensemble_begins_like_the_whole(trees):
    prepared, _ = trees
    rows, held = prepared.train.select("label", "features"), prepared.part("val")
    whole = M.boosted({"max_depth": 3, "n_estimators": 6}).fit(rows)
    short = M.boosted({"max_depth": 3, "n_estimators": 4}).fit(rows)
    cut = M.first_trees(whole, 4)
    assert cut.getNumTrees == 4

    def scores(model):
        return {r.row_id: r.score for r in M.score(model, held, "m").collect()}

    assert scores(cut) == pytest.approx(scores(short))


def test_search_finds_models_that_learn(trees):
    prepared, _ = trees
    found = M.search(prepared, trials=3)
    rows = found.trials.collect()
    assert sum(r.auroc > 0.55 for r in rows) >= 2 and len({r.auprc for r in rows}) == 3
    assert rows[0].auprc == max(r.auprc for r in rows)
    assert found.best["max_depth"] == rows[0].max_depth


# --- attributions --------------------------------------------------------------------


def brute_shapley(nodes, x):
    """Shapley values of one tree by the definition, over all feature sets."""

    def expect(node, known):
        if nodes[node][0] is None:
            return nodes[node][1]
        feature, cut, left, right = nodes[node]
        if feature in known:
            return expect(left if x[feature] <= cut else right, known)
        a, b = nodes["cover"][left], nodes["cover"][right]
        return (a * expect(left, known) + b * expect(right, known)) / (a + b)

    features = sorted({v[0] for k, v in nodes.items() if k != "cover" and v[0] is not None})
    out = np.zeros(len(x))
    n = len(features)
    for i in features:
        rest = [f for f in features if f != i]
        for k in range(n):
            share = factorial(k) * factorial(n - k - 1) / factorial(n)
            for known in combinations(rest, k):
                out[i] += share * (expect(0, {*known, i}) - expect(0, set(known)))
    return out


def test_tree_values_match_the_definition():
    # feature 0 is used twice on one path
    nodes = {
        0: (0, 5.0, 1, 2), 1: (1, 2.0, 3, 4), 2: (2, 1.0, 5, 6), 3: (0, 3.0, 7, 8),
        4: (None, 2.0), 5: (None, -1.0), 6: (None, 4.0), 7: (None, 0.5), 8: (None, -3.0),
        "cover": {0: 100, 1: 60, 2: 40, 3: 35, 4: 25, 5: 10, 6: 30, 7: 15, 8: 20},
    }
    leaves, groups = [(0, {})], {}
    while leaves:
        at, path = leaves.pop()
        if nodes[at][0] is None:
            groups.setdefault(len(path), []).append((0, nodes[at][1], path))
            continue
        f, cut, left, right = nodes[at]
        for child, is_left in ((left, True), (right, False)):
            low, high, capped, share = path.get(f, (-np.inf, np.inf, False, 1.0))
            part = nodes["cover"][child] / nodes["cover"][at]
            bound = (low, min(high, cut), True) if is_left else (max(low, cut), high, capped)
            leaves.append((child, {**path, f: (*bound, share * part)}))
    packed = [TA._pack(v, d) for d, v in groups.items()]
    rng = np.random.default_rng(0)
    x = np.vstack([rng.uniform(0, 8, (40, 3)), [[5.0, 2.0, 1.0]]])
    want = np.array([brute_shapley(nodes, row) for row in x])
    assert TA.row_impacts(x, packed) == pytest.approx(want)


@pytest.mark.parametrize("d", [1, 3, 6, 9])
def test_polynomials_equal_the_tables(d):
    rng = np.random.default_rng(d)
    g = TA.Leaves(
        tree=np.zeros(20, int), value=rng.normal(size=20), feature=np.tile(np.arange(d), (20, 1)),
        low=np.full((20, d), -np.inf), high=rng.uniform(0, 1, (20, d)),
        capped=np.ones((20, d), bool), share=rng.uniform(0.01, 1, (20, d)))
    x = rng.uniform(0, 1, (15, d))
    passed = TA._reached(x, g, slice(None))
    table = TA._shapley(g, slice(None))
    want = table[np.arange(20)[None, :], passed @ (1 << np.arange(d))]
    assert TA._shapley_by_row(passed, g.share, g.value) == pytest.approx(want)


def test_attributions_add_up(trees):
    prepared, model = trees
    groups = TA.collect_leaves(prepared.table.sparkSession, model)
    rows = prepared.part("test")
    impact = TA.tree_attributions(rows, model, prepared.names, groups=groups)
    assert impact.select("feature").distinct().count() == len(S.FEATURES)
    total = impact.groupBy("row_id").agg(F.sum("impact").alias("impact"))
    joined = total.join(M.score(model, rows, "m"), "row_id").collect()
    assert len(joined) == rows.count()
    for r in joined:
        odds = TA.base_value(groups) + r["impact"]
        assert 1 / (1 + np.exp(-odds)) == pytest.approx(r["score"])
    last = TA.staged_scores(rows, model).where(F.col("round") == model.getNumTrees)
    staged = {r["row_id"]: r["score"] for r in last.collect()}
    assert all(staged[r["row_id"]] == pytest.approx(r["score"]) for r in joined)
