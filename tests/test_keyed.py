import datetime

from pyspark.sql import functions as F

from shopscope.operators import keyed
from shopscope.sources import results

D = datetime.date


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_merges_columns(spark):
    old = spark.createDataFrame([("k1", 1, 2)], "k string, a int, b int")
    new = spark.createDataFrame([("k1", 9), ("k2", 3)], "k string, a int")
    assert rows(keyed.upsert(old, new, "k")) == [("k1", 9, 2), ("k2", 3, None)]
    assert keyed.inserted_keys(old, new, "k").count() == 1


def test_upsert_applies_updates_in_order(spark):
    old = spark.createDataFrame([("k1", 1, 2)], "k string, a int, b int")
    feed = spark.createDataFrame(
        [("k1", 5, None, 1), ("k1", None, 7, 2), ("k1", 6, None, 3), ("k2", None, 1, 1)],
        "k string, a int, b int, seq int",
    ).repartition(3)
    assert rows(keyed.upsert(old, feed, "k", order="seq")) == [("k1", 6, 7), ("k2", None, 1)]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert rows(keyed.duplicate_keys(df, "k", sparse=True)) == [("a", 2)]
    assert keyed.duplicate_keys(df, "k").count() == 2


def test_last_write_wins(spark):
    df = spark.createDataFrame([("u#1", 1, "x"), ("u#1", 2, "y"), ("u#2", 1, "z")], "row_key string, batch int, v string")
    assert rows(keyed.last_write(df, "row_key", "batch").select("row_key", "v")) == [("u#1", "y"), ("u#2", "z")]


def test_rank_limit_comes_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as user_id", "id as session_id", "timestamp_seconds(id) as start_time")
    plan = keyed.latest_sessions(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("WindowGroupLimit") > plan.rindex("Exchange")


def metrics(spark):
    return spark.sql(
        "select id % 4 as product_id, date_add(date'2024-12-30', cast(id as int)) as metric_date, id as views, "
        "id as cart_adds, id as purchases, cast(id as double) as revenue from range(100)"
    )


def test_metric_range_includes_both_ends(spark):
    got = keyed.metric_range(metrics(spark), 2, "2025-01-01", "2025-01-09", ["views"])
    assert rows(got) == [("2#2025-01-01", 2), ("2#2025-01-05", 6), ("2#2025-01-09", 10)]


def test_metrics_table_is_pruned(spark, tmp_path):
    results.write_daily_metrics(metrics(spark), str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    got = keyed.metric_range(stored, 2, "2025-01-01", "2025-01-09", ["views"])
    assert got.count() == 3
    scan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(metric_month" in scan
    assert "ReadSchema: struct<product_id:bigint,metric_date:date,views:bigint>" in scan


def test_retention(spark):
    days = spark.createDataFrame([(D(2025, 1, 1),), (D(2024, 12, 31),)], "day date")
    assert rows(keyed.retained(days, "day", "2025-04-01")) == [(D(2025, 1, 1),)]
    moments = days.select(F.col("day").cast("timestamp").alias("t"))
    assert keyed.retained(moments, "t", "2025-04-01 00:00:01").count() == 0


def test_point_get(spark, tmp_path):
    df = spark.createDataFrame([("a#1", 1), ("b#1", 2)], "row_key string, v int")
    results.write_wide_sessions(df, str(tmp_path / "w"))
    assert keyed.point_get(spark.read.parquet(str(tmp_path / "w")), "b#1").first()["v"] == 2
