"""JSON documents in, Parquet tables out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import cleaning, nested
from ..operators.keyed import duplicate_keys
from ..schemas import ENTITIES, UNIQUE_KEYS
from .loading import FILE_PATTERNS, broken_rules, load, rule_counts


def read_documents(
    spark: SparkSession, folder: str, entity: str, multiline: bool = True, pattern: str | None = None
) -> DataFrame:
    """Documents of one entity with its declared schema: no inference pass, and
    absent fields come back null. ``pattern`` replaces the entity's file names.

    A JSON array spread over lines cannot be split, so such a file is one task, and
    slow per document. ``land`` reads arrays once, as VARIANT. ``multiline=False``
    reads one document per line, which splits.
    """
    return (
        spark.read.schema(ENTITIES[entity])
        .option("multiLine", multiline)
        .option("pathGlobFilter", pattern or FILE_PATTERNS[entity])
        .json(folder)
    )


def land(spark: SparkSession, source: str, target: str, multiline: bool = True) -> DataFrame:
    """Rewrite the documents of every entity as a Parquet table, replacing what
    was there. Later reads split, prune columns and push filters down. Rows that a
    unique key refuses and what cannot be read go to a table of rejects; the report
    counts them (see ``loading``)."""
    return load(spark, source, target, multiline)


def read_landed(spark: SparkSession, folder: str, entity: str) -> DataFrame:
    return spark.read.schema(ENTITIES[entity]).parquet(f"{folder}/{entity}")


@dataclass(frozen=True)
class Store:
    """The cleaned frames the analytics take, over a folder of landed entities."""

    spark: SparkSession
    folder: str
    strict: bool = True

    def raw(self, entity: str) -> DataFrame:
        return read_landed(self.spark, self.folder, entity)

    @cached_property
    def users(self) -> DataFrame:
        return cleaning.clean_users(self.raw("users"), self.strict)

    @cached_property
    def products(self) -> DataFrame:
        return cleaning.clean_products(self.raw("products"), self.strict)

    @cached_property
    def transactions(self) -> DataFrame:
        return cleaning.clean_transactions(self.raw("transactions"), self.strict)

    @cached_property
    def sessions(self) -> DataFrame:
        # With the nested columns, for views and carts; a scan reads those that a query uses.
        return cleaning.clean_sessions(self.raw("sessions"), self.strict, nested=True)

    @cached_property
    def lines(self) -> DataFrame:
        return nested.line_items(self.transactions)

    @cached_property
    def views(self) -> DataFrame:
        return nested.session_views(self.sessions)

    @cached_property
    def carts(self) -> DataFrame:
        return nested.cart_lines(self.sessions)


def register_views(store, *names: str) -> None:
    """Name the cleaned tables, or only those in ``names``, for SQL."""
    for name in names or ("users", "products", "transactions", "sessions"):
        getattr(store, name).createOrReplaceTempView(name)


def key_violations(store: Store) -> DataFrame:
    """Rows that break a unique key: one row per entity, key and value."""
    found = None
    for entity, key, sparse in UNIQUE_KEYS:
        part = duplicate_keys(store.raw(entity), key, sparse).select(
            F.lit(entity).alias("entity"), F.lit(key).alias("key"),
            F.col(key).cast("string").alias("value"), "row_count",
        )
        found = part if found is None else found.unionByName(part)
    return found


def load_report(raw: dict[str, DataFrame]) -> DataFrame:
    """Rows read, kept by the cleaning step and breaking each of its rules, by table; one scan per table."""
    report = None
    for entity, df in raw.items():
        counts = rule_counts(entity, broken_rules(entity))
        one = df.agg(*counts)
        part = one.unpivot([], [F.col(f"`{n}`") for n in one.columns], "rule", "rows").select(F.lit(entity).alias("table"), "rule", "rows")
        report = part if report is None else report.unionByName(part)
    return report
