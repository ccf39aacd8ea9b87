"""Result tables: written by the executors, never through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

from ..functions import calendar

NESTED = (ArrayType, MapType, StructType)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats that hold flat columns only."""
    return df.select(*(
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, NESTED) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ))


def flat_schema(schema: StructType) -> StructType:
    return StructType([
        StructField(f.name, StringType() if isinstance(f.dataType, NESTED) else f.dataType) for f in schema.fields
    ])


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV result, all of its part files, with the schema it was written from."""
    return spark.read.schema(flat_schema(schema)).option("header", True).csv(path)


def write_daily_metrics(df: DataFrame, path: str) -> None:
    """Daily metrics laid out for lookups by product and date range.

    The table is partitioned by month. Rows are range-partitioned by month and
    product, so a heavy month takes several tasks and files, and a file holds
    few products: its min/max statistics skip it in most lookups.
    """
    order = ["metric_month", "product_id", "metric_date"]
    (
        df.withColumn("metric_month", calendar.month_label("metric_date"))
        .repartitionByRange("metric_month", "product_id")
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy("metric_month")
        .parquet(path)
    )


def write_wide_sessions(df: DataFrame, path: str, row_group_bytes: int = 8 << 20) -> None:
    """Wide sessions in row-key order: ranges of keys are files, and within a file small row groups whose statistics
    and Bloom filter tell which one can hold a key. A lookup by key or prefix opens few files and reads few row groups."""
    df.repartitionByRange("row_key").sortWithinPartitions("row_key").write.mode("overwrite").option(
        "parquet.bloom.filter.enabled#row_key", "true").option("parquet.block.size", row_group_bytes).parquet(path)
