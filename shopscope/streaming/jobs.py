"""Keyed tables fed by streams.

A micro-batch is written as its own ``batch_id`` folder, so a replay after a
failure overwrites its first attempt and nothing else is rewritten. Reading
takes the last write per key, over the newest snapshot that ``fold_batches`` made
and the batches after it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.keyed import last_write
from ..sources import folders
from ..sources.buckets import replace_days


def daily_views(events: DataFrame, user: str = "user_id", ts: str = "ts", watermark: str = "1 day") -> DataFrame:
    """A stream of views (``product_id``, user, time) with each product once per
    user and day, as the batch frames have it: ``product_id``, ``user_id``,
    ``metric_date``. Write it in append mode; ``daily_view_counts`` counts it.

    A day later than the watermark before the newest day is dropped (see
    ``late_rows``), and its state freed. Days are those of the written time.
    """
    return (
        events.select("product_id", F.col(user).alias("user_id"), F.date_trunc("day", ts).alias("_day"))
        .withWatermark("_day", watermark)
        .dropDuplicates(["product_id", "user_id", "_day"])
        .select("product_id", "user_id", F.to_date("_day").alias("metric_date"))
    )


def daily_view_counts(spark: SparkSession, path: str) -> DataFrame:
    """Views per product and day of what ``daily_views`` has written so far. A
    replayed batch counts once."""
    written = "product_id bigint, user_id bigint, metric_date date"
    return read_batches(spark, path, written).groupBy("product_id", "metric_date").agg(F.count("*").alias("views"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark dropped, over the batches the query still remembers."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def distinct_rows(rows: DataFrame, key: Sequence[str], ts: str, watermark: str = "1 day") -> DataFrame:
    """A stream without redeliveries of a key within the watermark."""
    return rows.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(key))


def write_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    output_mode: str = "update",
    key: Sequence[str] = (),
    order: Sequence[str] = (),
    **trigger,
) -> StreamingQuery:
    """Start writing ``stream`` to ``path``. With ``key`` and ``order``, a batch
    keeps only the last row per key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = last_write(batch, list(key), list(order)) if key else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(write)
        .start()
    )


SNAPSHOTS = "_snapshots"


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    return sorted(int(n.removeprefix(prefix)) for n in folders.names(spark, path) if n.startswith(prefix))


def _folded(spark: SparkSession, path: str) -> int:
    """The last batch that the newest snapshot holds; -1 without one."""
    return max(_numbers(spark, f"{path}/{SNAPSHOTS}", "through="), default=-1)


def read_batches(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """The rows at ``path`` with their ``batch_id``: those of the newest snapshot and of the batches after it. With ``schema``
    (that of the rows written), a stream that has put out no batch yet reads as no rows."""
    folded = _folded(spark, path)
    later = [f"{path}/batch_id={n}" for n in _numbers(spark, path, "batch_id=") if n > folded]
    if schema is not None:
        rows = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        schema = StructType([*rows.fields, StructField("batch_id", LongType())])
    parts = []
    if folded >= 0:
        reader = spark.read.schema(schema) if schema else spark.read
        parts.append(reader.parquet(f"{path}/{SNAPSHOTS}/through={folded}"))
    if later:
        reader = spark.read.schema(schema) if schema else spark.read
        parts.append(reader.option("basePath", path).parquet(*later).withColumn("batch_id", F.col("batch_id").cast("bigint")))
    if not parts:
        return spark.createDataFrame([], schema) if schema else spark.read.parquet(path)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_latest(
    spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str] = (), schema: str | StructType | None = None
) -> DataFrame:
    """Last write per key over all batches at ``path``: the newest by ``order``,
    and by batch among equals."""
    batches = read_batches(spark, path, schema)
    return last_write(batches, list(key), [*order, "batch_id"]).drop("batch_id")


def compact(spark: SparkSession, path: str, target: str, key: Sequence[str], order: Sequence[str] = ()) -> None:
    """Write the current state of ``path`` as one plain table."""
    read_latest(spark, path, key, order).write.mode("overwrite").parquet(target)


def fold_batches(spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str] = (), schema: str | StructType | None = None) -> int:
    """Fold all batches written so far into one snapshot of the last write per key, and retire them.

    The snapshot is named by the last batch in it and put in place by renaming, so it is whole as soon as it can be seen; reads
    pass over the batches it holds from then on. Only after that these batches and older snapshots are removed: a failure between the two steps leaves
    files, which the next call removes, and no wrong result. A batch that is replayed after it was folded is passed over
    as well. Returns the number of the last batch folded, -1 if there is none.
    """
    written = _numbers(spark, path, "batch_id=")
    last = max([*written, _folded(spark, path)], default=-1)
    if last > _folded(spark, path):
        latest = last_write(read_batches(spark, path, schema), list(key), [*order, "batch_id"])
        making = f"{path}/{SNAPSHOTS}/making-{uuid.uuid4().hex}"
        latest.write.parquet(making)
        folders.publish(spark, making, f"{path}/{SNAPSHOTS}/through={last}")
    retire_batches(spark, path)
    return last


def retire_batches(spark: SparkSession, path: str) -> None:
    """Remove the batches that a snapshot holds, older snapshots and what was left half made."""
    folded = _folded(spark, path)
    for n in _numbers(spark, path, "batch_id="):
        if n <= folded:
            folders.remove(spark, f"{path}/batch_id={n}")
    for name in folders.names(spark, f"{path}/{SNAPSHOTS}"):
        if name != f"through={folded}":
            folders.remove(spark, f"{path}/{SNAPSHOTS}/{name}")


VIEWS = "product_id bigint, user_id bigint, metric_date date"


def write_views_with_late(events: DataFrame, path: str, late: str, checkpoint: str, delay_days: int = 1, user: str = "user_id", ts: str = "ts", **trigger) -> StreamingQuery:
    """Start writing views (``product_id``, user, time) by day; rows that come too late are kept, too.

    A batch takes the rows no older than ``delay_days`` before the newest day of the batches before it, each product once per user and
    day, to ``path``; older rows go to the side table ``late``. Nothing is dropped. ``correct_days`` counts both.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Days only: a replayed batch does not see itself, so it splits as it did the first time.
        newest = read_batches(spark, path, VIEWS).filter(F.col("batch_id") < batch_id).agg(F.max("metric_date")).first()[0]
        rows = batch.select("product_id", F.col(user).alias("user_id"), F.to_date(ts).alias("metric_date")).filter("metric_date IS NOT NULL").distinct()
        in_time = F.lit(True) if newest is None else F.col("metric_date") >= F.date_sub(F.lit(newest), delay_days)
        rows.filter(in_time).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        rows.filter(~in_time).write.mode("overwrite").parquet(f"{late}/batch_id={batch_id}")

    return events.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start()


def correct_days(spark: SparkSession, path: str, late: str, table: str, after_batch: int = -1) -> int:
    """Count the days anew that batches after ``after_batch`` touched, in time or late, in a table of views partitioned by day.

    Only those days are read from the written views, by their statistics, and only their partitions are replaced. Returns the last batch counted, to
    be passed to the next call; counting a batch twice changes nothing.
    """
    both = read_batches(spark, path, VIEWS).unionByName(read_batches(spark, late, VIEWS))
    new = both.filter(F.col("batch_id") > after_batch)
    last = new.agg(F.max("batch_id")).first()[0]
    if last is None:
        return after_batch
    # One row per day.
    days = [r.metric_date for r in new.select("metric_date").distinct().collect()]
    if days:
        touched = both.filter(F.col("metric_date").isin(days)).select("product_id", "user_id", "metric_date").distinct()
        replace_days(touched.groupBy("product_id", "metric_date").agg(F.count("*").alias("views")), table)
    return last
