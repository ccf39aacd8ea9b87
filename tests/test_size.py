"""Work that must not pile up in a task when the tables outgrow the session's shuffle partitions."""

import json

import pytest
from pyspark.sql import functions as F

from shopscope.operators.pairs import Signal, item_pairs, top_pairs
from shopscope.plans import products
from shopscope.session import small_tasks
from shopscope.sources import loading
from shopscope.sources import warehouse

PARTITIONS = "spark.sql.shuffle.partitions"


@pytest.fixture
def one_partition(spark):
    old = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, "1")
    yield
    spark.conf.set(PARTITIONS, old)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_category_counts_are_dealt_to_tasks(spark):
    lines = spark.createDataFrame(
        [("t1", "u1", "p1", 5.0), ("t1", "u2", "p1", 5.0), ("t2", "u2", "p1", 2.0), ("t2", "u2", "p2", None),
         (None, "u3", "p2", 1.5), ("t3", None, "p2", 4.0), ("t4", "u4", "gone", 9.0), ("t2", "u2", "p1", 2.0)],
        "transaction_id string, user_id string, product_id string, subtotal double")
    catalogue = spark.createDataFrame([("p1", "c1"), ("p2", None)], "product_id string, category_id string")
    for tasks in (None, 5):
        revenue = products.revenue_by_category(lines, catalogue, tasks=tasks)
        assert [tuple(r) for r in revenue.collect()] == [("c1", 2, 2, 14.0, 3.5), (None, 2, 2, 5.5, 2.75)]
        # Both distinct counts come of one grouping, which the given number of tasks shares.
        assert plan(revenue).count("Expand") == 0
        assert ("REPARTITION_BY_NUM" in plan(revenue)) == (tasks is not None)


def test_tasks_follow_the_rows_of_a_table(spark, one_partition, tmp_path, monkeypatch):
    spark.range(1000).selectExpr("id AS l_orderkey").write.parquet(str(tmp_path / "lineitem.parquet"))
    shop = warehouse.Warehouse(spark, str(tmp_path))
    assert shop.tasks("lineitem") is None
    monkeypatch.setattr(warehouse, "TASK_ROWS", 90)
    assert shop.tasks("lineitem") == 12
    monkeypatch.setattr(warehouse, "TASK_ROWS", 1)
    assert shop.tasks("lineitem") == warehouse.MOST_TASKS


def test_pairs_are_built_in_small_tasks(spark, one_partition):
    """One partition for the session's shuffles, but several tasks for the pairs; the setting is as it was."""
    rows = spark.range(600_000).selectExpr("id DIV 3 AS basket", "xxhash64(id) AS item")
    pairs = item_pairs(rows, "basket", "item")
    assert len(pairs.inputFiles()) > 1
    assert spark.conf.get(PARTITIONS) == "1"
    assert pairs.agg(F.count("*"), F.sum("pair_count")).first() == (600_000, 600_000)


def test_pairs_outside_wide_baskets_are_not_counted_again(spark):
    """Pairs that no wide basket can lift are ranked as they are; those of wide baskets are summed, floor or not."""
    rows = spark.createDataFrame(
        [(b, i) for b in (1, 2) for i in (50, 51)] + [(3, i) for i in range(20)] + [(b, i) for b in (4, 5) for i in (7, 9)] + [(6, 7), (6, 50)],
        "basket bigint, item bigint")
    known = spark.range(100).selectExpr("id AS item")
    for limit in (2, 500):
        best = top_pairs([Signal(rows, "basket", "item", "n")], known, limit, seeds=2, block=16)
        assert [(r.item_a, r.item_b, r.n) for r in best.collect()][:2] == [(7, 9, 3), (50, 51, 2)]
        assert "reach" in best._jdf.queryExecution().optimizedPlan().toString() and best.count() == min(limit, 192)


def test_settings_return_after_a_failure(spark, one_partition):
    with pytest.raises(ZeroDivisionError), small_tasks(spark):
        assert int(spark.conf.get(PARTITIONS)) > 1
        1 / 0
    assert spark.conf.get(PARTITIONS) == "1"


def test_arrays_of_documents_are_sliced(spark, tmp_path):
    """Array elements are taken as they are, empty arrays have none, and what is no array is a document."""
    texts = ['[]', '[null, 7, [1], {"user_id": "a", "age": "old", "geo_data": 3}, {"user_id": null, "age": 5}]', '{"user_id": "b"}', "7", "null",
             '[[]]', "{}", '[{"user_id": "lost"}, {"us']
    for n, text in enumerate(texts):
        (tmp_path / f"{n}.txt").write_text(text)
    docs = loading.read_variants(spark, str(tmp_path), "users", pattern="*.txt")
    assert "variant_explode" in plan(docs)
    got = sorted((r._file[-5], r._position, r.user_id, r.age, r._reason) for r in loading.typed_rows(docs, "users").collect() if r.user_id) + sorted(
        (r._file[-5], r._position, r._reason) for r in loading.typed_rows(docs, "users").collect() if not r.user_id)
    assert got == [
        ("1", 3, "a", None, "unreadable: age, geo_data"), ("2", 0, "b", None, None),
        ("1", 0, "no document"), ("1", 1, "no document"), ("1", 2, "no document"), ("1", 4, None),
        ("3", 0, "no document"), ("4", 0, "no document"), ("5", 0, "no document"), ("6", 0, None), ("7", 0, "malformed text"),
    ] and json.loads(texts[1])[3]["user_id"] == "a"
