"""Registered queries against their SQL twins at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
#: Checked at a larger scale by tests/compare.py; too slow for every test run.
SLOW = {"m26_density"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_matches_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["m8_tree_classifier", "m9_logistic", "m24_kmeans"])
def test_model_queries_return_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0
