"""Every registered query against its oracle SQL on the smallest tables."""

import pytest

from marketloom.queries import registry
from tests.compare import assert_same, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    assert_same(QUERIES[name](spark, SF), con, ORACLES[name])


# Model training is checked in test_models.py, on fewer trees.
SLOW = {"random_forest", "gradient_boosting", "feature_importance", "model_comparison", "linear_regression"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert len(e.queries()) >= 100
