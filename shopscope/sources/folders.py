"""Folders of stored tables, on whatever file system the path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _open(spark, path)
    return files.exists(folder)


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, sorted; nothing if there is no such folder."""
    files, folder = _open(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(folder)) if files.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    files, folder = _open(spark, path)
    files.delete(folder, True)


def publish(spark: SparkSession, made: str, path: str) -> None:
    """Put the folder ``made`` in the place of ``path`` by renaming, after it is complete.

    Readers see the old table or the new one; what was there is removed last.
    """
    files, target = _open(spark, path)
    _, source = _open(spark, made)
    files.mkdirs(target.getParent())
    old = None
    if files.exists(target):
        _, old = _open(spark, f"{path}.old-{uuid.uuid4().hex}")
        if not files.rename(target, old):
            raise OSError(f"cannot move {path}")
    if not files.rename(source, target):
        raise OSError(f"cannot move {made} to {path}")
    if old is not None:
        files.delete(old, True)
