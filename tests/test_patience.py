"""Search, folds and refit stop alike, and end."""

from caretide.operators import boosting, models as M
from caretide.plans import catalog, model_queries as Q


def test_registered_fits_share_the_patience_of_the_search(spark, monkeypatch):
    seen, fit = [], M.fit_boosted

    def short(train, validation, parameters=None, patience=20, seed=1, **options):
        seen.append(patience)
        return fit(train, validation, {"max_depth": 2, "n_estimators": 2}, patience, seed, **options)

    monkeypatch.setattr(M, "fit_boosted", short)
    monkeypatch.setattr(Q, "_MADE", {})
    made = {}
    for name, fits in (("e14_search", 10), ("e15_cross_validation", 5), ("e16_refit_and_save", 1)):
        seen.clear()
        made[name] = catalog.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
        assert seen == [30] * fits, name
    assert {"mean_auprc", "high_variance"} <= set(made["e15_cross_validation"][0].asDict())


def test_a_fit_ends_when_patience_runs_out(spark):
    """The real fit, with the patience and the most rounds of the search."""
    made = Q._inputs(spark, "/root/testdata/sf0.001")
    prepared = made.prepared("xgb")
    slow = {"max_depth": 3, "learning_rate": 0.05, "n_estimators": 1000}
    found = boosting.fit(prepared.train, prepared.part("val"), slow, M.TUNED_PATIENCE)
    best, stopped = boosting.decide(found.precision, M.TUNED_PATIENCE)
    assert stopped and best == found.model.getNumTrees
    assert len(found.precision) < 1000
