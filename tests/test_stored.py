"""Stored tables of which an update rewrites a part, lookups in them, folded batches, late rows."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from shopscope.operators import keyed
from shopscope.sources import buckets, folders, results
from shopscope.streaming import jobs


def files(path):
    return {str(p.relative_to(path)) for p in pathlib.Path(path).rglob("*.parquet")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    old = spark.range(1000).selectExpr("CAST(id AS string) AS k", "id AS a", "id * 2 AS b")
    table = buckets.BucketedTable(spark, str(tmp_path / "t"), "k", 32)
    table.create(old)
    before = files(tmp_path / "t")
    new = spark.createDataFrame([("5", -1), ("new", 7), (None, 9)], "k string, a bigint")
    touched = {f"bucket={r[0]}" for r in new.filter("k IS NOT NULL").select(F.pmod(F.xxhash64("k"), F.lit(32))).collect()}
    assert table.upsert(new) == {"inserted": 1, "matched": 1}
    after = files(tmp_path / "t")
    assert {f for f in before if f.split("/")[0] not in touched} == {f for f in after if f.split("/")[0] not in touched}
    assert not {f for f in before if f.split("/")[0] in touched} & after
    assert rows(table.read()) == rows(keyed.upsert(old, new.filter("k IS NOT NULL"), "k"))
    assert rows(table.get("5")) == [("5", -1, 10)] and table.get("none").count() == 0


def test_upsert_in_order_and_of_nothing(spark, tmp_path):
    table = buckets.BucketedTable(spark, str(tmp_path / "t"), "k", 4)
    table.create(spark.createDataFrame([("k1", 1, 2)], "k string, a int, b int"))
    feed = spark.createDataFrame([("k1", 5, None, 1), ("k1", None, 7, 2), ("k1", 6, None, 3), ("k2", None, 1, 1)], "k string, a int, b int, seq int")
    assert table.upsert(feed, order="seq") == {"inserted": 1, "matched": 1}
    assert rows(table.read()) == [("k1", 6, 7), ("k2", None, 1)]
    kept = files(tmp_path / "t")
    assert table.upsert(feed.limit(0), order="seq") == {"inserted": 0, "matched": 0} and files(tmp_path / "t") == kept


def test_a_bucket_is_read_alone(spark, tmp_path):
    table = buckets.BucketedTable(spark, str(tmp_path / "t"), "k", 16)
    table.create(spark.range(500).selectExpr("id AS k", "id AS v"))
    got = table.get(77)
    assert len(got.inputFiles()) > 1 and rows(got) == [(77, 77)]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in text and "EqualTo(k,77)" in text


def test_days_are_replaced_and_retired_by_folder(spark, tmp_path):
    daily = spark.sql("SELECT id % 3 AS product_id, date_add(DATE'2024-01-01', CAST(id / 3 AS int)) AS metric_date, id AS views FROM range(30)")
    path = str(tmp_path / "d")
    buckets.replace_days(daily, path)
    before = files(path)
    buckets.replace_days(daily.filter("metric_date = '2024-01-04'").withColumn("views", F.lit(0).cast("long")), path)
    assert {f for f in before if "2024-01-04" not in f} == {f for f in files(path) if "2024-01-04" not in f}
    assert spark.read.parquet(path).filter("metric_date = '2024-01-04'").agg(F.sum("views")).first()[0] == 0
    kept = {f for f in files(path) if f >= "metric_date=2024-01-03"}
    assert buckets.drop_days(spark, path, "2024-01-03") == ["metric_date=2024-01-01", "metric_date=2024-01-02"]
    assert files(path) == kept and buckets.drop_days(spark, path, "2024-01-03") == []
    assert spark.read.parquet(path).count() == keyed.retained(daily, "metric_date", "2024-01-03", days=0).count() == 24


def test_lookup_reads_a_part_of_the_wide_table(spark, tmp_path):
    keys = spark.range(200_000).selectExpr("concat(lpad(id % 5000, 5, '0'), '#', id) AS row_key", "md5(CAST(id AS string)) AS v").repartition(8)
    path = str(tmp_path / "w")
    results.write_wide_sessions(keys, path, row_group_bytes=64 << 10)
    wide = spark.read.parquet(path)
    one = keyed.point_get(wide, "00042#42")
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(row_key), EqualTo(row_key,00042#42)]" in scan and one.count() == 1
    assert "GreaterThanOrEqual(row_key,00042#)" in keyed.prefix_get(wide, "00042#")._jdf.queryExecution().executedPlan().toString()
    assert keyed.prefix_get(wide, "00042#").count() == 40
    # Files hold ranges of keys, so one of them can hold the key; in it, most row groups are told by statistics.
    import pyarrow.parquet as pq

    held = 0
    for f in sorted(pathlib.Path(path).glob("*.parquet")):
        meta = pq.ParquetFile(f).metadata
        groups = [meta.row_group(g).column(0) for g in range(meta.num_row_groups)]
        held += sum(c.statistics.min <= "00042#42" <= c.statistics.max for c in groups)
    assert held == 1 and len(files(path)) > 1


def batches(spark, path, *content):
    for n, part in enumerate(content):
        if part is not None:
            spark.createDataFrame(part, "k string, ts int, v string").write.mode("overwrite").parquet(f"{path}/batch_id={n}")


FIRST = [("a", 1, "a1"), ("b", 5, "b5")], [("a", 2, "a2"), ("c", 1, "c1")]
LATER = [("b", 4, "b4"), ("a", 2, "a2 again"), ("d", 1, "d1")]


def state(spark, path):
    return {r.k: r.v for r in jobs.read_latest(spark, path, ["k"], ["ts"]).collect()}


def test_reads_after_folding_pass_over_old_batches(spark, tmp_path):
    path = str(tmp_path / "s")
    batches(spark, path, *FIRST)
    assert jobs.fold_batches(spark, path, ["k"], ["ts"]) == 1
    assert folders.names(spark, path) == ["_snapshots"]
    batches(spark, path, None, None, LATER)
    assert state(spark, path) == {"a": "a2 again", "b": "b5", "c": "c1", "d": "d1"}
    assert jobs.fold_batches(spark, path, ["k"], ["ts"]) == 2 and folders.names(spark, f"{path}/_snapshots") == ["through=2"]
    assert state(spark, path) == {"a": "a2 again", "b": "b5", "c": "c1", "d": "d1"}
    assert jobs.fold_batches(spark, path, ["k"], ["ts"]) == 2


def test_a_crash_before_batches_retire_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    batches(spark, path, *FIRST)
    with monkeypatch.context() as m:
        m.setattr(jobs, "retire_batches", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.fold_batches(spark, path, ["k"], ["ts"])
    assert "batch_id=0" in folders.names(spark, path)
    used = jobs.read_batches(spark, path).inputFiles()
    assert used and all("_snapshots" in f for f in used)
    # A folded batch that is replayed is passed over.
    batches(spark, path, None, FIRST[1])
    assert state(spark, path) == {"a": "a2", "b": "b5", "c": "c1"}
    jobs.fold_batches(spark, path, ["k"], ["ts"])
    assert folders.names(spark, path) == ["_snapshots"] and state(spark, path) == {"a": "a2", "b": "b5", "c": "c1"}


def test_a_crash_while_folding_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    batches(spark, path, *FIRST)
    with monkeypatch.context() as m:
        m.setattr(folders, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.fold_batches(spark, path, ["k"], ["ts"])
    assert state(spark, path) == {"a": "a2", "b": "b5", "c": "c1"}
    jobs.fold_batches(spark, path, ["k"], ["ts"])
    assert folders.names(spark, f"{path}/_snapshots") == ["through=1"]


def test_nothing_to_fold(spark, tmp_path):
    assert jobs.fold_batches(spark, str(tmp_path / "none"), ["k"], schema="k string, ts int, v string") == -1


def test_late_views_are_kept_and_counted(spark, tmp_path):
    rng = random.Random(4)
    views = [(rng.randrange(5), rng.randrange(20), f"2024-01-{1 + k // 40:02d} 10:00:00") for k in range(400)]
    late = [v for k, v in enumerate(views) if k % 9 == 0]
    parts = [[v for k, v in enumerate(views) if k % 9 and k // 100 == n] for n in range(4)] + [late]
    folder = tmp_path / "in"
    folder.mkdir()
    for n, part in enumerate(parts):
        spark.createDataFrame(part, "product_id bigint, user_id bigint, ts string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(folder / f"n={n}"))
    paths = [str(tmp_path / n) for n in ("views", "late", "daily")]

    def run():
        stream = spark.readStream.schema("product_id bigint, user_id bigint, ts timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(folder))
        jobs.write_views_with_late(stream, *paths[:2], str(tmp_path / "checkpoint")).awaitTermination()

    run()
    last = jobs.correct_days(spark, *paths)
    want = sorted({(p, t[:10]): 0 for p, _, t in views})
    counted = {k: len({u for p, u, t in views if (p, t[:10]) == k}) for k in want}
    got = {(r.product_id, str(r.metric_date)): r.views for r in spark.read.parquet(paths[2]).collect()}
    assert got == counted and last == 4
    assert not jobs.read_batches(spark, paths[1], jobs.VIEWS).isEmpty()
    # Rows of one day, long after: only that day's files change.
    before = files(paths[2])
    spark.createDataFrame([(77, 1, "2024-01-02 09:00:00")], "product_id bigint, user_id bigint, ts string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(folder / "n=9"))
    run()
    assert jobs.correct_days(spark, *paths, after_batch=last) == 5
    assert {f for f in before if "01-02" not in f} == {f for f in files(paths[2]) if "01-02" not in f}
    assert spark.read.parquet(paths[2]).filter("product_id = 77").first().views == 1
