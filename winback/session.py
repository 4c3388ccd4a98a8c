"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot key's partition even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Plans are built from many small expressions; recording the source line of each one
    # costs more than the rest of building them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local master without the setting may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="winback-"))
    return context.getCheckpointDir()


# The lists of folders that `transient` is to delete, innermost last, per thread.
_passing = threading.local()


def new_folder(spark: SparkSession, label: str) -> str:
    folder = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for folders in getattr(_passing, "folders", [])[-1:]:
        folders.append(folder)
    return folder


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def transient(spark: SparkSession) -> Iterator[list[str]]:
    """Folders made inside are deleted at the end; for results that the driver has collected by then.

    A folder that nothing will read any more can be deleted and taken off the list before.
    """
    outer = getattr(_passing, "folders", [])
    _passing.folders = [*outer, mine := []]
    try:
        yield mine
    finally:
        _passing.folders = outer
        for folder in mine:
            delete_folder(spark, folder)


# Called with every frame that is about to be materialised; tests look at the plans.
watchers: list[Callable[[DataFrame], None]] = []


# Rows of a file of stored lines. A reading task is given a few dozen such files at most, so
# what it gathers of their rows before an exchange stays bounded, however large the table.
FILE_ROWS = 50_000

# Compressed bytes of lines that a task is given of an exchange, where the caller names no
# other size. Spark's 64 MB are some two million lines, and joining them and dropping
# duplicates holds each in memory.
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
TASK_BYTES = "32m"


def bound_tasks(spark: SparkSession) -> None:
    """Smaller tasks for exchanged lines, unless the session has a size of its own."""
    if spark.conf.get(ADVISORY, None) is None:
        spark.conf.set(ADVISORY, TASK_BYTES)


def materialise(df: DataFrame, label: str = "stage", file_rows: int | None = None) -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    Used where one result feeds several branches, or where partition numbers must
    not be computed twice. The files outlive lost executors. `file_rows` bounds the rows
    of a file, for frames whose readers aggregate nearly as many groups as rows.
    """
    folder = new_folder(df.sparkSession, label)
    for watch in watchers:
        watch(df)
    writer = df.write.option("maxRecordsPerFile", file_rows) if file_rows else df.write
    writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
