"""Every registered query against its SQL at the smallest size."""

from __future__ import annotations

import pytest

from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import REGISTRY
from tickloom.operators import model


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    assert differences(spark, con, name, sf) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(REGISTRY)


def test_model_queries_train_the_whole_model(spark, sf, monkeypatch):
    specs, real = [], model.train

    def recorded(rows, spec=model.ModelSpec()):
        specs.append(spec)
        return real(rows, model.ModelSpec(trees=2, depth=2))

    monkeypatch.setattr(model, "train", recorded)
    for name in ("gbt_scores", "gbt_evaluation", "top_importances"):
        assert not REGISTRY[name](spark, sf).isEmpty()
    assert [s.trees for s in specs] == [300] * 3
