"""Where intermediate tables live, and how a plan is cut into one.

Intermediate results that must not be computed twice (range numbering, stage
tables) are written as Parquet under the folder the session names in
``spark.checkpoint.dir``.  A written table survives lost executors, keeps the
columns prunable and needs no recomputation of its lineage.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_open = threading.local()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for intermediate tables; shared storage on a cluster."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="recordweave-")


def _located(spark: SparkSession, path: str):
    """The file system of a path, and the path on it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, target = _located(spark, path)
    return files.exists(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote, on whatever file system it is."""
    files, target = _located(spark, path)
    files.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    files, target = _located(spark, path)
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []


def make_folder(spark: SparkSession, path: str) -> None:
    files, target = _located(spark, path)
    files.mkdirs(target)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, whose being there is all it says."""
    files, target = _located(spark, path)
    files.create(target, True).close()


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, after the block, the intermediate tables this thread writes inside it.

    For blocks that end with their result written elsewhere.  Outside of one,
    intermediate tables stay, as checkpoints do, since lazy frames still read them.
    """
    outer, _open.paths = getattr(_open, "paths", None), []
    try:
        yield
    finally:
        written, _open.paths = _open.paths, outer
        for path in written:
            delete_folder(spark, path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as an intermediate table and return the table read back."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    if getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
