"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle_check import compare, connect

from __spark_entry__ import entry
from rowflow.plans.catalog import QUERIES
from rowflow.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["order_date", "total_orders", "total_revenue", "avg_order_value", "unique_customers"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLE[name]) == ""
