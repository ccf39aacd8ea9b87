"""Stored tables of which an update rewrites a part: hash buckets for upserts, days for daily metrics.

Both are plain partitioned Parquet. An update computes the new content of the partitions it touches and
replaces those alone (dynamic partition overwrite); the files of the others stay as they are. A replacement is committed as a whole by
Spark after all of its files are written, so an update that fails changes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.keyed import merge_updates, upsert
from . import folders


def replace_partitions(df: DataFrame, path: str, by: str, order: str) -> None:
    """Replace the partitions of ``by`` that ``df``, dealt out by it, has rows of."""
    df.sortWithinPartitions(by, order).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


@dataclass(frozen=True)
class BucketedTable:
    """Rows with a unique ``key``, in ``buckets`` folders by its hash. The number of buckets stays as it was at ``create``."""

    spark: SparkSession
    path: str
    key: str
    buckets: int = 64

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def create(self, df: DataFrame) -> None:
        """Write the table anew."""
        self._placed(df).repartitionByRange("bucket", self.key).sortWithinPartitions("bucket", self.key).write.mode("overwrite").partitionBy("bucket").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop("bucket")

    def get(self, value) -> DataFrame:
        """The row of one key, from its bucket alone."""
        type_ = self.spark.read.parquet(self.path).schema[self.key].dataType
        bucket = self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(value).cast(type_)), F.lit(self.buckets)).cast("int")).first()[0]
        return self.spark.read.parquet(self.path).filter((F.col("bucket") == bucket) & (F.col(self.key) == value)).drop("bucket")

    def upsert(self, updates: DataFrame, order: str | None = None) -> dict[str, int]:
        """Merge ``updates`` in, as ``keyed.upsert`` does, reading and rewriting only the buckets of its keys.

        Columns that only the updates have are added there; other buckets read them as null once the table is read with
        ``mergeSchema``. Updates without a key are left out. Returns the numbers of inserted and matched keys, counted on the same pass.
        """
        updates = updates.filter(F.col(self.key).isNotNull())
        if order is not None:
            updates = merge_updates(updates, self.key, order)
        # At most ``buckets`` numbers.
        touched = [r.bucket for r in self._placed(updates).select("bucket").distinct().collect()]
        if not touched:
            return {"inserted": 0, "matched": 0}
        current = self.spark.read.parquet(self.path).filter(F.col("bucket").isin(touched)).drop("bucket")
        merged = upsert(current.withColumn("_old", F.lit(True)), updates.withColumn("_new", F.lit(True)), self.key)
        seen = Observation()
        counted = merged.observe(
            seen, F.count_if(F.col("_old").isNull()).alias("inserted"), F.count_if(F.col("_old") & F.col("_new")).alias("matched"))
        # By hash, a bucket to a task: dealing out by range would sample the rows first, and count them twice.
        replace_partitions(self._placed(counted.drop("_old", "_new")).repartition("bucket"), self.path, "bucket", self.key)
        return dict(seen.get)


def replace_days(daily: DataFrame, path: str, day: str = "metric_date", order: str = "product_id") -> None:
    """Replace the days that ``daily`` has rows of in a table partitioned by day; a heavy day takes several tasks."""
    replace_partitions(daily.repartitionByRange(day, order), path, day, order)


def drop_days(spark: SparkSession, path: str, before, day: str = "metric_date") -> list[str]:
    """Retention: remove the partitions of days before a date, and return their names. Nothing is rewritten or read."""
    old = [n for n in folders.names(spark, path) if n.startswith(f"{day}=") and n.split("=", 1)[1] < str(before)]
    for name in old:
        folders.remove(spark, f"{path}/{name}")
    return old
