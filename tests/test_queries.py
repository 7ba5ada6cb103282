"""Every registered query against its SQL counterpart, on the smallest tables."""

import pytest

from __spark_entry__ import entry
from check_queries import compare, connect
from tidegrid.plans.catalog import QUERIES
from tidegrid.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert sorted(QUERIES) == sorted(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name) is None


def test_entry(spark):
    assert entry(spark).columns == ["total_citizens", "affected", "unaffected", "affected_pct"]
