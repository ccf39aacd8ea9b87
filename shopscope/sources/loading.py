"""Documents into tables: write, audit, publish.

A load reads the JSON of an entity once, into a staging folder. The rows that break a rule of the cleaning step are counted
while they are written (``Observation``), by a bitmask with a bit per rule. The staged table is audited for its
unique keys, violating rows go to a table of rejects with what could not be read, and the rest takes the place of the
published table by renaming its folder. A load that fails leaves the published table as it was.

A JSON array is read as one VARIANT per file and taken apart there, which costs a twentieth of the typed reader's
time per document; files beyond ``MOST_ARRAY_BYTES`` (a VARIANT holds 128 MB) go through the typed reader, document by document. One
document per line (``multiline=False``) splits at any size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.keyed import duplicate_keys
from ..schemas import ENTITIES, UNIQUE_KEYS
from . import folders

# Sessions come as any number of files.
FILE_PATTERNS = {name: f"{name}.json" for name in ENTITIES} | {"sessions": "sessions_*.json"}
MOST_ARRAY_BYTES = 64 << 20

#: Why the cleaning step drops a row, in the order of their bits.
RULES: dict[str, dict[str, str]] = {
    "categories": {},
    "users": {"user_id missing": "user_id IS NULL", "registration_date missing": "registration_date IS NULL"},
    "products": {
        "product_id missing": "product_id IS NULL", "category_id missing": "category_id IS NULL",
        "base_price missing": "base_price IS NULL OR isnan(base_price)",
    },
    "sessions": {
        "session_id missing": "session_id IS NULL", "user_id missing": "user_id IS NULL", "start_time missing": "start_time IS NULL",
        "duration not positive": "duration_seconds IS NULL OR duration_seconds <= 0",
    },
    "transactions": {
        "transaction_id missing": "transaction_id IS NULL", "user_id missing": "user_id IS NULL", "timestamp missing": "timestamp IS NULL",
        "total missing": "total IS NULL OR isnan(total)", "total not positive": "total <= 0",
    },
}


def broken_rules(entity: str) -> Column:
    """A bit per rule of the entity that a row breaks; zero for a row that the cleaning step keeps."""
    bits = [F.when(F.expr(test), 1 << k).otherwise(0) for k, test in enumerate(RULES[entity].values())]
    return sum(bits, F.lit(0))


def rule_counts(entity: str, broken: Column) -> list[Column]:
    """Aggregates: rows read, rows kept, and rows that break each rule."""
    per_rule = [F.count_if(broken.bitwiseAND(1 << k) != 0).alias(rule) for k, rule in enumerate(RULES[entity])]
    return [F.count(F.lit(1)).alias("rows in"), F.count_if(broken == 0).alias("rows kept"), *per_rule]


def read_variants(
    spark: SparkSession, folder: str, entity: str, multiline: bool = True, pattern: str | None = None, most_bytes: int = MOST_ARRAY_BYTES
) -> DataFrame:
    """Documents of one entity as they stand: ``file``, ``position`` (in the file's order), ``doc`` and, where the text of a
    file (of a line) is no JSON, that text as ``malformed``."""

    def reader():
        return spark.read.option("pathGlobFilter", pattern or FILE_PATTERNS[entity]).option("recursiveFileLookup", True).option(
            "multiLine", multiline).option("columnNameOfCorruptRecord", "malformed")

    file, order = F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("position")
    whole = reader().option("singleVariantColumn", "doc").schema("doc variant, malformed string").json(folder)
    if not multiline:
        return whole.select(file, order, "doc", "malformed")
    # A file holds an array of documents, or one.
    # An array's elements are sliced out of its VARIANT as they are; a cast to array<variant> would build each anew.
    files = whole.filter(F.col("_metadata.file_size") <= most_bytes).select(file, "doc", "malformed")
    array = F.when(F.expr("try_variant_get(doc, '$[0]', 'variant')").isNotNull(), F.col("doc"))
    small = (
        files.lateralJoin(spark.tvf.variant_explode_outer(array.outer()))
        .filter("pos IS NOT NULL OR try_variant_get(doc, '$', 'array<variant>') IS NULL")
        .select("file", F.coalesce("pos", F.lit(0)).alias("position"), F.coalesce("value", "doc").alias("doc"), "malformed")
    )
    typed = reader().schema(f"{ENTITIES[entity]}, malformed string").json(folder).filter(F.col("_metadata.file_size") > most_bytes)
    fields = F.struct(*(c for c in typed.columns if c != "malformed"))
    doc = F.when(F.col("malformed").isNull(), F.call_function("to_variant_object", fields))
    large = typed.select(file, order, doc.alias("doc"), "malformed")
    return small.select("file", F.col("position").cast("bigint").alias("position"), "doc", "malformed").unionByName(large)


def typed_rows(docs: DataFrame, entity: str) -> DataFrame:
    """The declared columns of each document, absent ones null, behind ``_file``, ``_position``, ``_text`` and ``_reason``.

    ``_reason`` says what could not be read: a text that is no JSON, an element that is no document (both without any
    column), or top-level fields whose value does not fit the declared type and is null for that. ``_text`` then holds the source.
    """
    fields = StructType.fromDDL(ENTITIES[entity]).fieldNames()
    row = docs.withColumn("row", F.expr(f"try_variant_get(doc, '$', 'struct<{ENTITIES[entity]}>')"))
    lost = F.array_compact(F.array(*(
        F.when(F.col(f"row.{c}").isNull() & F.expr(f"try_variant_get(doc, '$.{c}', 'string')").isNotNull(), F.lit(c))
        for c in fields)))
    reason = (
        F.when(F.col("malformed").isNotNull(), F.lit("malformed text")).when(F.col("row").isNull(), F.lit("no document"))
        .when(F.size(lost) > 0, F.concat(F.lit("unreadable: "), F.array_join(lost, ", ")))
    )
    return row.withColumn("reason", reason).select(
        F.col("file").alias("_file"), F.col("position").alias("_position"),
        F.when(F.col("reason").isNotNull(), F.coalesce("malformed", F.expr("to_json(doc)"))).alias("_text"),
        F.col("reason").alias("_reason"), "row.*")


def _is_row() -> Column:
    return F.col("_reason").isNull() | F.col("_reason").startswith("unreadable")


def key_conflicts(staged: DataFrame, entity: str) -> DataFrame:
    """Rows that a unique key refuses: ``_file``, ``_position``, ``key``.

    The first row of a key in the order of files and positions stays. Keys are checked one after the other, each on the rows that
    the ones before it let pass; a null is a value like any other unless the key is sparse.
    """
    rows, refused = staged.filter(_is_row()), None
    for _, key, sparse in (k for k in UNIQUE_KEYS if k[0] == entity):
        # The keys that occur twice are few; their rows are found by a join, however many there are.
        twice = duplicate_keys(rows, key, sparse).select(F.col(key).alias("_key"))
        same = F.col(key).eqNullSafe(F.col("_key"))
        shared = rows.join(twice, same, "left_semi")
        first = shared.groupBy(key).agg(F.min(F.struct("_file", "_position")).alias("_first")).select(F.col(key).alias("_key"), "_first")
        late = shared.join(first, same).filter(F.struct("_file", "_position") != F.col("_first")).select("_file", "_position", F.lit(key).alias("key"))
        refused = late if refused is None else refused.unionByName(late)
        rows = rows.join(late, ["_file", "_position"], "left_anti")
    return refused if refused is not None else staged.select("_file", "_position", F.lit("").alias("key")).limit(0)


def load_entity(spark: SparkSession, source: str, target: str, entity: str, multiline: bool = True, pattern: str | None = None) -> dict[str, int]:
    """Load one entity; returns its counts by rule. Runs jobs."""
    staging = f"{target}/_staging/{uuid.uuid4().hex}"
    seen = Observation()
    rows = typed_rows(read_variants(spark, source, entity, multiline, pattern), entity).withColumn("_broken", F.when(_is_row(), broken_rules(entity)).otherwise(-1))
    unread = F.count_if(~_is_row()).alias("unreadable")
    read, kept, *rules = rule_counts(entity, F.when(F.col("_broken") >= 0, F.col("_broken")))
    rows.observe(seen, read, kept, unread, F.count_if(F.col("_reason").startswith("unreadable")).alias("unreadable field"), *rules).write.parquet(f"{staging}/rows")
    counts = {k: v or 0 for k, v in seen.get.items()}

    staged = spark.read.parquet(f"{staging}/rows")
    at = ["_file", "_position"]
    key_conflicts(staged, entity).write.parquet(f"{staging}/conflicts")
    conflicts = spark.read.parquet(f"{staging}/conflicts")
    refused = {r.key: r.n for r in conflicts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts |= {f"{key} repeated": refused.get(key, 0) for e, key, _ in UNIQUE_KEYS if e == entity}

    fields = StructType.fromDDL(ENTITIES[entity]).fieldNames()
    twice = staged.join(conflicts, at).select(*at, F.concat(F.col("key"), F.lit(" repeated")).alias("reason"), F.to_json(F.struct(*fields)).alias("text"))
    unread = staged.filter(F.col("_reason").isNotNull()).select(*at, F.col("_reason").alias("reason"), F.col("_text").alias("text"))
    unread.union(twice).select(F.col("_file").alias("file"), F.col("_position").alias("position"), "reason", "text").write.parquet(f"{staging}/rejects")

    table = f"{staging}/rows"
    if counts["unreadable"] or refused:
        table = f"{staging}/table"
        staged.filter(_is_row()).join(conflicts, at, "left_anti").select(*fields).write.parquet(table)
    # Without rejected rows the staged files are the table: readers ask for the declared columns.
    folders.publish(spark, table, f"{target}/{entity}")
    folders.publish(spark, f"{staging}/rejects", f"{target}/_rejects/{entity}")
    folders.remove(spark, staging)
    return counts


def load(
    spark: SparkSession, source: str, target: str, multiline: bool = True, entities: Iterable[str] = tuple(ENTITIES), patterns: dict[str, str] | None = None
) -> DataFrame:
    """Load entities from JSON under ``source`` as tables under ``target``, replacing what was there.

    Returns the report: ``table``, ``rule``, ``rows``; rules include rows in and kept by the cleaning step, rows refused by a
    unique key and what could not be read (``rejects`` lists them). Runs jobs.
    """
    report = []
    for entity in entities:
        counts = load_entity(spark, source, target, entity, multiline, (patterns or {}).get(entity))
        report += [(entity, rule, n) for rule, n in counts.items()]
    return spark.createDataFrame(report, "table string, rule string, rows bigint")


def rejects(spark: SparkSession, target: str, *entities: str) -> DataFrame:
    """What loads of the entities refused: ``table``, ``file``, ``position``, ``reason``, ``text``."""
    found = None
    for entity in entities:
        part = spark.read.schema("file string, position bigint, reason string, text string").parquet(f"{target}/_rejects/{entity}")
        part = part.select(F.lit(entity).alias("table"), "*")
        found = part if found is None else found.unionByName(part)
    return found
