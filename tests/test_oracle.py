"""Every query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from oracle_compare import connect, differences
from shelfmill.plans.catalog import all_queries
from shelfmill.plans.oracles import all_oracles

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_each_query_has_a_twin():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    assert differences(all_queries()[name](spark, SF_DIR), con, all_oracles()[name]) == []


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0
