"""Registered queries use the full settings, not smaller ones."""

from __future__ import annotations

import pytest

from checks import query_learned
from shelftide.forecast.linear import Linear
from shelftide.forecast.tree import Tree
from shelftide.plans.features import model_feature_names


class Fitted(Exception):
    pass


def settings(monkeypatch, kind, key):
    def fit(self, *_):
        raise Fitted(self)

    monkeypatch.setattr(query_learned, "_train", lambda *_: None)
    monkeypatch.setattr(kind, "fit", fit)
    monkeypatch.setattr(kind, "cross_validate", fit, raising=False)
    with pytest.raises(Fitted) as found:
        query_learned.QUERIES[key](None, "")
    return found.value.args[0]


@pytest.mark.parametrize(("key", "trees", "depth"), [
    ("tree_random_forest", 100, 15), ("tree_gradient_boosting", 100, 6), ("tree_boosted_colsample", 100, 6),
    ("importance_detail", 100, 15), ("feature_importance", 100, 15),
])
def test_trees(monkeypatch, key, trees, depth):
    got = settings(monkeypatch, Tree, key)
    assert (got.num_trees, got.max_depth) == (trees, depth)


@pytest.mark.parametrize("key", ["linear_ols_full", "linear_ridge_full", "linear_lasso_full", "linear_elasticnet_full", "cross_validate_full"])
def test_linear_models_have_all_features(monkeypatch, key):
    assert list(settings(monkeypatch, Linear, key).features) == list(model_feature_names())
