"""Every registered query against its SQL, and row checks for those without one."""

import pytest
from compare import difference, duck
from conftest import SMALL

import __spark_entry__ as contract
from tripworks.plans import oracles, queries

QUERIES, SQL = queries.REGISTRY, oracles.all_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SMALL), connection, SQL[name]) is None


def test_only_fitted_models_lack_sql():
    assert set(SQL) <= set(QUERIES)
    fitted = {"kmeans_assign", "heavy_cluster_distances", "gbt_predict", "oof_gbt", "oof_forest", "param_sweep"}
    assert set(QUERIES) - set(SQL) == fitted


def test_flagship_has_rows(spark):
    assert contract.entry(spark).count() > 0
