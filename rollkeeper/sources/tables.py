"""Target tables: a batch is written to folders of its own, then published in one commit.

The manifest is a table of rows (seq, batch_id, table, bucket, folder, whole), one file per
commit. A folder that no commit names, left by a run that broke off, is never read; a batch
that runs again writes new folders, so it may read the very state that it replaces. The
last commit counts, whatever the batches' names.

A table may be kept in buckets of its key. A batch then reads and writes the buckets that
hold its keys, and the commit names these; all others stay the files they are.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PUBLISHED = "published"
MANIFEST = "seq bigint, batch_id string, table string, bucket int, folder string, whole boolean"
#: Buckets of a table that is kept so. Fixed for the life of a table.
BUCKETS = 64
NO_BUCKET = -1


def _manifest(spark: SparkSession, base: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).parquet(f"{base}/{PUBLISHED}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def bucket_of(key: list[Column]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


def write_attempt(df: DataFrame, base: str, table: str, batch_id: str, key: list[str] | None = None) -> dict[int, str]:
    """Writes a table to a new folder, which nobody reads yet; returns its folder, or with
    ``key`` one for each bucket that has rows."""
    folder = f"{table}/{batch_id}-{uuid.uuid4().hex}"
    if key is None:
        df.write.parquet(f"{base}/{folder}")
        return {NO_BUCKET: folder}
    rows = df.withColumn("_bucket", bucket_of([F.col(k) for k in key]))
    rows.write.partitionBy("_bucket").parquet(f"{base}/{folder}")
    back = df.sparkSession.read.schema(f"{_first(df)}, _bucket int").parquet(f"{base}/{folder}")
    held = sorted(r["_bucket"] for r in back.select("_bucket").distinct().collect())
    return {n: f"{folder}/_bucket={n}" for n in held} or {NO_BUCKET: folder}


def _first(df: DataFrame) -> str:
    field = df.schema.fields[0]
    return f"`{field.name}` {field.dataType.simpleString()}"


class TwoWriters(RuntimeError):
    """Two runs have published to one base folder at the same time."""


def publish(spark: SparkSession, base: str, batch_id: str, folders: dict[str, dict[int, str]], whole: bool = True) -> None:
    """One commit: from now on these folders are the tables (name -> bucket -> folder).

    ``whole``: they are all of their tables; else they replace the buckets named. A base
    folder has one writer at a time. There is no lock: a run that finds its commit's number
    taken by another one fails, and so does the other, so that neither goes unnoticed.
    """
    known = _manifest(spark, base)
    last = known.agg(F.max("seq")).first()[0] if known is not None else None
    number = (last or 0) + 1
    rows = [
        (number, batch_id, table, bucket, folder, whole) for table, parts in folders.items() for bucket, folder in parts.items()
    ]
    if not rows:
        return
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{base}/{PUBLISHED}")
    if _manifest(spark, base).filter(F.col("seq") == number).count() != len(rows):
        raise TwoWriters(f"commit {number} under {base} was written twice")


def last_commit(spark: SparkSession, base: str, table: str) -> int | None:
    """The number of the commit that published a table last."""
    known = _manifest(spark, base)
    return None if known is None else known.filter(F.col("table") == table).agg(F.max("seq")).first()[0]


def write_table(df: DataFrame, base: str, table: str, batch_id: str, key: list[str] | None = None) -> None:
    """One batch of one table, published at once."""
    publish(df.sparkSession, base, batch_id, {table: write_attempt(df, base, table, batch_id, key)})


def table_folders(spark: SparkSession, base: str, table: str, batch_id: str | None = None) -> dict[int, str]:
    """The folders that make a table as it was last published, or last published by a batch."""
    known = _manifest(spark, base)
    if known is None:
        return {}
    rows = known.filter(F.col("table") == table)
    if batch_id is not None:
        upto = rows.filter(F.col("batch_id") == batch_id).agg(F.max("seq")).first()[0]
        rows = rows.filter(F.col("seq") <= (upto or 0))
    since = rows.filter("whole").agg(F.max("seq")).first()[0]
    last = rows.filter(F.col("seq") >= (since or 0)).groupBy("bucket").agg(F.max_by("folder", "seq").alias("folder"))
    return {r.bucket: r.folder for r in last.collect()}  # a row for each bucket, however many commits there are


def read_table(
    spark: SparkSession, base: str, table: str, batch_id: str | None = None, buckets: list[int] | None = None
) -> DataFrame:
    """A table as it was last published, or last published by a batch; ``buckets``: only these."""
    folders = table_folders(spark, base, table, batch_id)
    if not folders:
        raise FileNotFoundError(f"no published batch of {table} under {base}")
    schema = spark.read.parquet(f"{base}/{next(iter(folders.values()))}").schema
    if buckets is not None and NO_BUCKET not in folders:
        folders = {n: f for n, f in folders.items() if n in buckets}
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{base}/{f}" for f in folders.values()])


def append_log(df: DataFrame, base: str, log: str, by: tuple[str, ...] = ("batch_id",)) -> None:
    """Change log, rejects or warnings, one folder per batch (and what else ``by`` names).
    A batch that runs again replaces its own folder and no other."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(f"{base}/{log}")


def hidden(value: Column, key: str | None) -> Column:
    """Personal data in a log: a keyed hash, which nobody without the key can list, or null."""
    if key is None:
        return F.lit(None).cast("string")
    inner = F.sha2(F.concat(F.lit(f"{key}:"), value.cast("string")), 256)
    return F.sha2(F.concat(F.lit(f"{key}:"), inner), 256)


def reject_rows(
    rejects: DataFrame, batch_id: str, stage: str, reason: str, hide: list[str] | None = None, key: str | None = None
) -> DataFrame:
    """Rejects in their stored form; columns in ``hide`` as in ``hidden``."""
    hide = hide or []
    values = [
        (hidden(F.col(c), key) if c in hide else F.col(c)).alias(c) for c in rejects.columns if c != reason
    ]
    return rejects.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(stage).alias("stage"),
        F.col(reason).alias("reason"),
        F.to_json(F.struct(*values)).alias("row"),
    )


def store_rejects(rejects: DataFrame, base: str, log: str = "rejects") -> None:
    """Adds rejects in their stored form; a stage of a batch that runs again replaces its own."""
    append_log(rejects, base, log, ("batch_id", "stage"))
