"""Stream results against the same computation in batch."""

from pyspark.sql import functions as F

from shopscope.plans import trends
from shopscope.streaming import jobs

SCHEMA = "view_id bigint, product_id bigint, ts timestamp"


def stream_of(spark, tmp_path, *batches):
    """A file stream whose files come one per micro-batch, in order."""
    folder = tmp_path / "in"
    folder.mkdir()
    for n, rows in enumerate(batches):
        part = spark.createDataFrame(rows, "view_id bigint, product_id bigint, ts string")
        part.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(folder / f"part={n}"))
    return (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
        .parquet(str(folder))
    )


def run(stream, tmp_path, **options):
    query = jobs.write_batches(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), **options)
    query.awaitTermination()


FIRST = [(1, 7, "2025-01-01 10:00:00"), (2, 7, "2025-01-01 11:00:00"), (3, 8, "2025-01-02 09:00:00")]
SECOND = [(4, 7, "2025-01-01 23:00:00"), (5, 8, "2025-01-02 10:00:00"), (6, 7, "2025-01-05 00:00:00")]
LATE = [(7, 7, "2025-01-01 12:00:00"), (8, 7, "2025-01-05 01:00:00")]


def views(stream):
    """Each view by a user of its own."""
    return jobs.daily_views(stream, user="view_id")


def counts(spark, tmp_path):
    got = jobs.daily_view_counts(spark, str(tmp_path / "out"))
    return sorted((r.product_id, str(r.metric_date), r.views) for r in got.collect())


def test_daily_views_equal_batch(spark, tmp_path):
    run(views(stream_of(spark, tmp_path, FIRST, SECOND)), tmp_path, output_mode="append")
    assert counts(spark, tmp_path) == [(7, "2025-01-01", 3), (7, "2025-01-05", 1), (8, "2025-01-02", 2)]


def test_views_behind_the_watermark_are_dropped(spark, tmp_path):
    """Late rows are judged by the watermark as it stood a batch before, and counted."""
    between = [(9, 7, "2025-01-05 00:30:00")]
    stream = views(stream_of(spark, tmp_path, FIRST, SECOND, between, LATE))
    query = jobs.write_batches(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), "append")
    query.awaitTermination()
    assert counts(spark, tmp_path) == [(7, "2025-01-01", 3), (7, "2025-01-05", 3), (8, "2025-01-02", 2)]
    assert jobs.late_rows(query) == 1


def test_a_product_counts_once_per_user_and_day(spark, tmp_path):
    again = [(1, 7, "2025-01-01 22:00:00"), (1, 7, "2025-01-02 08:00:00")]
    run(views(stream_of(spark, tmp_path, FIRST, again)), tmp_path, output_mode="append")
    assert counts(spark, tmp_path) == [(7, "2025-01-01", 2), (7, "2025-01-02", 1), (8, "2025-01-02", 1)]


def test_stream_equals_the_batch_counters(spark, tmp_path):
    """Events of both kinds in several files, against the batch plan over the same rows."""
    rows = [(n, n % 4 + 1, f"2025-01-0{n % 3 + 1} {n % 24:02d}:10:00", n % 5) for n in range(60)]
    events = spark.createDataFrame(rows, "event_id int, product_id bigint, ts string, user_id bigint").withColumn(
        "ts", F.col("ts").cast("timestamp")).orderBy("ts")
    events.repartitionByRange(4, "ts").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    run(jobs.daily_views(stream, watermark="3 days"), tmp_path, output_mode="append")
    sessions = events.select("user_id", F.to_date("ts").alias("start_time"), "product_id").distinct()
    batch = trends.product_daily_metrics(sessions).select("product_id", F.col("metric_date").cast("string"), "views")
    assert counts(spark, tmp_path) == sorted(tuple(r) for r in batch.collect())


def test_nothing_written_reads_as_no_rows(spark, tmp_path):
    assert jobs.daily_view_counts(spark, str(tmp_path / "none")).count() == 0
    assert jobs.read_latest(spark, str(tmp_path / "none"), ["k"], schema="k string, v int").columns == ["k", "v"]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    run(views(stream_of(spark, tmp_path, FIRST, SECOND)), tmp_path, output_mode="append")
    before = counts(spark, tmp_path)
    last = max((tmp_path / "out").glob("batch_id=*"), key=lambda p: int(p.name.split("=")[1]))
    again = spark.read.parquet(str(last))
    again.write.mode("overwrite").parquet(str(tmp_path / "copy"))
    spark.read.parquet(str(tmp_path / "copy")).write.mode("overwrite").parquet(str(last))
    assert counts(spark, tmp_path) == before


def test_redelivered_rows_count_once(spark, tmp_path):
    once = jobs.distinct_rows(stream_of(spark, tmp_path, FIRST, FIRST), ["view_id"], "ts")
    run(once, tmp_path, output_mode="append")
    assert sorted(r.view_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_latest_row_per_key(spark, tmp_path):
    stream = stream_of(spark, tmp_path, SECOND, FIRST)
    run(stream, tmp_path, output_mode="append", key=["product_id"], order=["ts"])
    jobs.compact(spark, str(tmp_path / "out"), str(tmp_path / "table"), ["product_id"], ["ts"])
    got = {r.product_id: r.view_id for r in spark.read.parquet(str(tmp_path / "table")).collect()}
    assert got == {7: 6, 8: 5}
