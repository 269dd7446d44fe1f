"""Ensembles take the presets that a session has fitted to the same rows."""

from types import SimpleNamespace

from rarefy.operators import ensemble_fit as EF
from rarefy.operators import models as MD
from rarefy.plans import catalog_models as C


def test_members_are_not_fitted_twice(spark, monkeypatch):
    fits = []

    def fit_model(name, *a, **kw):
        fits.append(name)
        return SimpleNamespace(name=name, pipeline=None, transform=lambda df: df)

    monkeypatch.setattr(C, "_MEMO", {})
    monkeypatch.setattr(C, "model_data", lambda *a, **kw: SimpleNamespace(train=None, test=None, features=["a"]))
    monkeypatch.setattr(MD, "fit_model", fit_model)
    monkeypatch.setattr(EF, "fit_model", fit_model)
    monkeypatch.setattr(MD, "metrics_of", lambda *a: {})
    first = C.ENSEMBLE_MEMBERS[1:]
    res = C.trained(spark, "here", first)
    got = C.members(spark, "here")
    assert list(got) == C.ENSEMBLE_MEMBERS and sorted(fits) == sorted(C.ENSEMBLE_MEMBERS)
    assert all(got[n] is res[n].model for n in first)
    assert C.members(spark, "here") == got and len(fits) == len(C.ENSEMBLE_MEMBERS)
    # other tables have their own fits
    C.members(spark, "there")
    assert len(fits) == 2 * len(C.ENSEMBLE_MEMBERS)
