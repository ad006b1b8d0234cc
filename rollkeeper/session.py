"""Spark session for tests and the bench, and the shared folder for written tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(name: str = "rollkeeper", cpus: str = "*", **conf: str) -> SparkSession:
    """A local session; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        # Wide rows mean thousands of column calls; do not record a call site for each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the session."""
    sc = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="rollkeeper-"))
    return sc.getCheckpointDir()


_RUNS: list[list[str]] = []


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The plan before it runs once however often the result is used, a lost executor
    costs no recomputation, and the files tell Spark the size to plan joins with.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _RUNS:
        _RUNS[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def steps_of_a_run(spark: SparkSession):
    """Removes at its end what ``written`` has stored inside; for runs whose results lie elsewhere by then.

    Gives the list of the folders; one that is taken out of it stays.
    """
    _RUNS.append([])
    try:
        yield _RUNS[-1]
    finally:
        for path in _RUNS.pop():
            drop(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    """Removes a folder that ``written`` has made, through Spark's own file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
