"""Files that tasks write to the shared folder, and the table that says which of them count.

A task names its files by partition and attempt; the rows it returns name them too. Those
rows are stored as a table, so only files of attempts that Spark has committed are read,
whatever a lost executor has left behind. The folder must be one that ``pyarrow.fs`` can
open from the executors (file, hdfs, s3, gs).
"""

from __future__ import annotations

import uuid

import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from rollkeeper.session import shared_folder


def located(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    uri = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    store, path = located(uri)
    store.create_dir(path)
    return uri


def own_name(folder: str, number: int, ending: str) -> str:
    """A name for this attempt's file with this number."""
    task = TaskContext.get()
    return f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId():08d}-{number:05d}{ending}"


def spread_files(manifest: DataFrame) -> DataFrame:
    """The rows of a manifest dealt to as many tasks as a shuffle would have."""
    return manifest.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
