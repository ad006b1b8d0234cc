"""Kept fingerprints of a state, in buckets, so that the next night's rows are dealt out to them.

The files are written as a bucketed table in a folder of their own and published like any
other table of a batch. A session that reads them declares the table over that folder; the
declaration is dropped again, the files stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rollkeeper.operators.snapshot import with_row_fingerprint
from rollkeeper.sources.tables import NO_BUCKET, last_commit, publish, table_folders

#: The name tells how they are worked out: those of another kind are not found, and the state is hashed once more.
FINGERPRINTS = "joined_fingerprints"
#: Buckets of the fingerprints. Each is read by one task; fixed for the life of a base folder.
BUCKETS = 64


def write_fingerprints(
    df: DataFrame, base: str, batch_id: str, names: list[str], blank_is_null: bool = False, buckets: int = BUCKETS
) -> dict[int, str]:
    """Writes the distinct fingerprints of the columns ``names`` to a new folder, which nobody
    reads yet; for ``publish``."""
    folder, table = f"{FINGERPRINTS}/{batch_id}-{uuid.uuid4().hex}", f"kept_{uuid.uuid4().hex}"
    marks = with_row_fingerprint(df, names, blank_is_null).select("_fp").distinct().repartition(buckets, "_fp")
    marks.write.format("parquet").bucketBy(buckets, "_fp").sortBy("_fp").option("path", f"{base}/{folder}").saveAsTable(table)
    df.sparkSession.sql(f"DROP TABLE {table}")  # of the declaration only, as the path was given
    return {NO_BUCKET: folder}


def keep_fingerprints(df: DataFrame, base: str, batch_id: str, names: list[str], blank_is_null: bool = False) -> None:
    """The fingerprints of one batch, published at once."""
    publish(df.sparkSession, base, batch_id, {FINGERPRINTS: write_fingerprints(df, base, batch_id, names, blank_is_null)})


def kept_fingerprints(spark: SparkSession, base: str, state: str | None = None, buckets: int = BUCKETS) -> DataFrame | None:
    """The fingerprints as last published, in their buckets; None if there are none, or if the
    table ``state``, whose they are, has been published without them since."""
    folders = table_folders(spark, base, FINGERPRINTS)
    if not folders or state and last_commit(spark, base, state) != last_commit(spark, base, FINGERPRINTS):
        return None
    table, place = f"kept_{uuid.uuid4().hex}", f"{base}/{folders[NO_BUCKET]}"
    spark.sql(
        f"CREATE TABLE {table} (_fp BINARY) USING parquet CLUSTERED BY (_fp) SORTED BY (_fp) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    kept = spark.table(table)
    kept.schema  # looked up before the declaration goes
    spark.sql(f"DROP TABLE {table}")
    return kept
