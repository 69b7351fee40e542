"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry_point
from check_oracles import compare, connect
from stargauge.registry import oracles, spark_queries
from support import SMALL

ORACLES = entry_point.oracle_sql()
WITHOUT_SQL = {
    "attach_factors", "svd_factors", "recipe_forest", "fit_linear", "fit_forest", "fit_boosting", "fit_mlp",
    "kfold_recipe",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.count() == 5719 and "movie_std_rating" in frame.columns


def test_which_queries_have_sql():
    assert set(spark_queries.QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    assert compare(spark, duck, SMALL, name) is None


@pytest.mark.parametrize("name", ["fit_linear", "kfold_recipe"])
def test_query_without_sql_runs(spark, name):
    assert entry_point.queries()[name](spark, SMALL).count() > 0
