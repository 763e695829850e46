"""Every query with SQL agrees with DuckDB; those without run and give the promised columns."""

import os

import pytest

import __spark_entry__ as entry
from etholake.operators import flips
from etholake.plans.queries import ORACLE_SQL, QUERIES
from tests.helpers import SF, connection, same

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connection()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_agrees(spark, con, name):
    same(QUERIES[name](spark, SF), con, ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["flip_classifier_accuracy", "flip_classifier_apply"])
def test_classifier_queries_take_the_whole_model(spark, monkeypatch, name):
    """100 trees and a kernel of 51, as the reference has them."""
    models, kernels = [], []
    fit, smoothed = flips.fit, flips.smoothed
    monkeypatch.setattr(flips, "fit", lambda *a, **b: models.append(fit(*a, **b)) or models[-1])
    monkeypatch.setattr(flips, "smoothed", lambda d, flag, kernel: kernels.append(kernel) or smoothed(d, flag, kernel))
    QUERIES[name](spark, SF)
    assert [m.stages[0].getNumTrees for m in models] == [100]
    assert kernels == ([51] if name == "flip_classifier_apply" else [])
