"""Shared scratch space: the session's checkpoint folder, and run folders below it."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FILES_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"
# Files a task writes at once where rows go to folders by a column; only rows for more are sorted first.
WRITERS = 16
_lock = threading.Lock()
# Blocks of ``settings`` that are open, by session and setting, and what was set before the first.
_open: dict[tuple[SparkSession, str], tuple[int, str | None]] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    ``spark.checkpoint.dir`` is read first. Only where neither it nor the context names a
    folder (a plain local session, as in tests) is a local one set. On a cluster that would be
    a folder of one machine: there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if configured is None and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="fleetlake-"))
        current = spark.sparkContext.getCheckpointDir()
    return configured or current


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder, unique to this call."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for as long as the block runs. Blocks that are open at the same time, in
    threads, share them; the last one to end puts back what was there."""
    with _lock:
        for key, value in values.items():
            n, old = _open.get((spark, key)) or (0, spark.conf.get(key, None))
            _open[spark, key] = n + 1, old
            spark.conf.set(key, value)
    try:
        yield
    finally:
        with _lock:
            for key in values:
                n, old = _open.pop((spark, key))
                if n > 1:
                    _open[spark, key] = n - 1, old
                elif old is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, old)


def shuffles_dropped(spark: SparkSession):
    """What is written in the block drops its shuffle files as soon as it is written.

    Else they stay until the driver happens to collect its garbage, which a large heap puts off: the
    files of all steps of a job would lie on the disks together.
    """
    return settings(spark, **{_SHUFFLE_CLEANUP: "true"})


def materialised(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once below the checkpoint folder and read it back.

    Cuts the lineage like a checkpoint and survives lost executors. Unlike one it leaves
    the real size in the plan, so a later join knows whether this side may be broadcast.
    With a column ``by`` of few values, reading some of them leaves the others' files alone.
    """
    return _written(df, run_folder(df.sparkSession, name), by)


@contextmanager
def at_rest(df: DataFrame, name: str, by: str | None = None) -> Iterator[DataFrame]:
    """``materialised`` for as long as the block runs: its files are deleted then."""
    spark, path = df.sparkSession, run_folder(df.sparkSession, name)
    try:
        yield _written(df, path, by)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _written(df: DataFrame, path: str, by: str | None) -> DataFrame:
    spark = df.sparkSession
    with shuffles_dropped(spark):
        if by:
            with settings(spark, **{_FILES_AT_ONCE: str(WRITERS)}):
                df.write.partitionBy(by).parquet(path)
        else:
            df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    return rows.select(*df.columns) if by else rows  # a column of the folders' names is read last
