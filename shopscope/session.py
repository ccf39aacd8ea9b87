"""A session with the settings this library expects, and its scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Timestamps are zone-less text in the sources; one zone everywhere keeps days and keys equal.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join on a hot key is split even where that costs the next operator its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keyed streaming state outgrows the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


#: Shuffles are cut this fine, and adaptive execution joins the pieces to tasks of about this size; files are read in splits of that.
SMALL_TASKS = 1000
SMALL_TASK_BYTES = 8 << 20
SMALL_SPLIT_BYTES = 16 << 20


def get_session(app: str = "shopscope", master: str | None = None, **settings: str) -> SparkSession:
    """Session with ``SETTINGS``; on a cluster leave ``master`` to spark-submit.

    Shuffle partitions are left to the deployment: set them high and let
    adaptive execution coalesce.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Fresh folder for written intermediate tables and stream checkpoints.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``.
    Only a local session, whose tasks all see the same disk, may fall back to a
    temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/shopscope-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="shopscope-")


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Jobs run in here work in tasks of a bounded size, whatever number of partitions the session has set.

    For steps whose groups are nearly as many as their rows: a task holds all of its groups, so its memory is that of
    its share of the rows. The session's own settings are put back at the end.
    """
    wanted = {
        "spark.sql.shuffle.partitions": str(max(SMALL_TASKS, int(spark.conf.get("spark.sql.shuffle.partitions")))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SMALL_TASK_BYTES),
        "spark.sql.files.maxPartitionBytes": str(SMALL_SPLIT_BYTES),
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once
    however often it is used, with a size the planner knows, and safe from the
    loss of an executor. Runs a job."""
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
