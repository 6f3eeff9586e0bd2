"""Every registered query on the smallest tables, against DuckDB where it has a SQL text."""

import os

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry

FOLDER = os.environ.get("ORDERLOOM_TEST_DATA", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()
# Model training on every run is left to the check tool and the model tests.
SLOW = {"kmeans_sweep", "feature_set_experiments", "segmentation_run", "model_cv", "param_search", "forecast_run", "retrain_run",
        "svm_categorise", "gbt_categorise", "categoriser_leaderboard", "text_run", "dbscan_orders"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, con, name):
    problem = compare(con, spark, FOLDER, QUERIES[name], SQL.get(name))
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
