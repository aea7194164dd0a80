"""The registered search draws as often as a full run, not as a quick one."""

from types import SimpleNamespace

from caretide.operators import models as M
from caretide.plans import catalog, model_queries as Q


def test_search_makes_a_hundred_trials(spark, monkeypatch):
    asked = []

    def search(prepared, trials, **options):
        asked.append(trials)
        rows = [(n, 0.5) for n in range(trials)]
        return SimpleNamespace(trials=spark.createDataFrame(rows, "trial int, auprc double"))

    monkeypatch.setattr(M, "search", search)
    monkeypatch.setattr(Q, "_MADE", {})
    monkeypatch.setattr(Q._Inputs, "prepared", lambda self, kind: None)
    found = catalog.QUERIES["e14_search"](spark, "/root/testdata/sf0.001").collect()
    assert asked == [100] and len(found) == 100
    assert "range(100)" in catalog.ORACLES["e14b_search_properties"]
    draws = M.draw_parameters(100)
    assert draws[:10] == M.draw_parameters(10) and len({tuple(d.values()) for d in draws}) == 100
