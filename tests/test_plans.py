"""The plans Spark makes of the catalogue: what must not be in them."""

import os
import re

import pytest
from pyspark.sql import functions as F

from shopscope.operators.keyed import latest_sessions
from shopscope.plans import products
from shopscope.registry.catalogue import QUERIES
from shopscope.sources.warehouse import Warehouse

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

# Global aggregates (one row), rolling means over weeks, and top-k results of fixed size.
ONE_PARTITION = {
    "conversion_funnel", "conversion_funnel_cart", "funnel_percentages", "funnel_totals", "status_filter_forms",
    "upsert_inserted", "weekly_trend", "row_key_lookup", "documents_funnel",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_plan(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert bad not in text
    assert name in ONE_PARTITION or "SinglePartition" not in text


def test_scan_reads_only_what_is_used(spark):
    text = plan(products.product_purchases(Warehouse(spark, FOLDER).lines))
    schemas = sorted(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert [[c.split(":")[0] for c in s.split(",")] for s in schemas] == [
        ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"],
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"],
    ]


def test_filters_reach_the_scan(spark):
    text = plan(Warehouse(spark, FOLDER).views)
    assert re.search(r"PushedFilters: \[.*In\(event_type, \[click,view\]\)", text)
    text = plan(Warehouse(spark, FOLDER).transactions)
    assert "GreaterThan(o_totalprice,0.0)" in text and "IsNotNull(o_custkey)" in text


def test_session_arrays_are_built_only_when_shown(spark):
    sessions = Warehouse(spark, FOLDER).sessions
    assert "collect_list" in plan(sessions)
    assert "collect_list" not in plan(sessions.groupBy("device_type").sum("viewed_count"))
    assert "collect_list" not in plan(latest_sessions(sessions.select("user_id", "session_id", "start_time")))


def test_large_sides_are_not_broadcast(spark):
    """Past the size limit every join has another way."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("product_popularity", "revenue_by_category", "clv_scores", "cohort_analysis", "revenue_by_referrer"):
            text = plan(QUERIES[name](spark, FOLDER))
            assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_product_is_split(spark):
    """Half of the lines are of one product; the join splits its partition."""
    lines = spark.range(0, 200_000, 1, 8).selectExpr(
        "id as transaction_id", "id % 50 as user_id", "'completed' as status",
        "if(id % 2 = 0, 7, id % 999) as product_id", "1.25d as subtotal",
    )
    catalogue = spark.range(1000).selectExpr("id as product_id", "id % 5 as category_id")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        result = products.revenue_by_category(lines, catalogue)
        got = {r.category_id: (r.num_transactions, r.total_revenue) for r in result.collect()}
        assert "skew=true" in plan(result)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    expected = lines.groupBy((F.col("product_id") % 5).alias("c")).count().collect()
    assert got == {r.c: (r["count"], r["count"] * 1.25) for r in expected}


def test_daily_metrics_read_the_events_once(spark):
    text = plan(QUERIES["product_daily_metrics"](spark, FOLDER))
    assert len(re.findall(r"FileScan parquet \[[^]]*event_type", text)) == 1
