"""The corpus pipeline: documents in, token files out.

Stages, each reading all that the one before kept: toxic documents go, one document of each near-duplicate
group stays, documents that hold a benchmark item go, sources are mixed to token targets (a document comes
out as often as the mix takes it), and the texts are written as token files, one row per document out.

Every stage but the last returns the columns of its input. Rows are identified by doc_id: rows that share an
id and a text stay or go together. A null id is judged like any other. Documents without text are kept by the filters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopscope.llm import decontaminate, mixing, neardup, tokenfiles, toxicity
from shopscope.llm.tables import table, vocabulary
from shopscope.session import scratch_dir, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Trained on the labelled documents of the stage's input."""
    model = toxicity.fit_on(docs, table(spark, folder, "labels"))
    return toxicity.without_toxic(docs, model)


#: Jaccard similarity in hundredths from which two documents are near duplicates in the pipeline; operator 9 by itself has a threshold of its own.
NEAR = 80


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return neardup.without_near_duplicates(docs, percent=NEAR)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, table(spark, folder, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return tokenfiles.encode(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("token_output", write_tokens),
]

#: No stage before the last can be said in SQL (a trained model, sketches); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
