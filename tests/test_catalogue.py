"""Every catalogue query against SQL on another engine, and properties of the results."""

import os

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as contract
from shopscope.registry.catalogue import QUERIES
from shopscope.registry.counterparts import ORACLE_SQL
from shopscope.sources.warehouse import Warehouse

FOLDER = os.environ.get("CATALOGUE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def other():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_agrees_with_sql(spark, other, name):
    assert differences(QUERIES[name](spark, FOLDER), other, ORACLE_SQL[name]) == []


def test_contract(spark):
    assert set(QUERIES) == set(ORACLE_SQL) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() == 15


def test_every_user_is_in_one_segment(spark):
    users = Warehouse(spark, FOLDER).users.count()
    for name in ("clv_segment_distribution", "clv_segment_dense"):
        assert QUERIES[name](spark, FOLDER).agg(F.sum("num_users")).first()[0] == users


def test_funnel_narrows(spark):
    row = QUERIES["conversion_funnel_cart"](spark, FOLDER).first()
    assert row.total_sessions >= row.viewed_product >= row.added_to_cart > 0


def test_weeks_add_up(spark):
    weekly = QUERIES["weekly_revenue"](spark, FOLDER).agg(F.sum("total_revenue")).first()[0]
    kept = Warehouse(spark, FOLDER).transactions.filter("status != 'refunded'").agg(F.sum("total")).first()[0]
    assert weekly == pytest.approx(kept, rel=1e-9)


def test_pairs_are_ordered(spark):
    assert QUERIES["item_pairs_purchase"](spark, FOLDER).filter("item_a >= item_b").isEmpty()
