"""The test tables as the operators read them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file, as installed on every machine."""
    return str(public_tokenizers.path(name))
