"""The stamped history: append only, one folder per day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeeper.contract import STAMP, STAMP_DAY, Contract


def batch_stamp(moment: datetime) -> datetime:
    """The run's stamp: five digits of a second, one value for the whole batch."""
    return moment.replace(microsecond=moment.microsecond // 10 * 10)


def read_history(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """History from Parquet; the schema is the contract's, so nothing is inferred."""
    return spark.read.schema(contract.history_schema()).parquet(path)


def read_history_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int, parts: int, **options: str
) -> DataFrame:
    """History from a database, read in ``parts`` slices of a numeric column."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column)
        .options(lowerBound=lower, upperBound=upper, numPartitions=parts, **options)
        .load()
    )


def stamped(rows: DataFrame, moment: datetime) -> DataFrame:
    return rows.withColumn(STAMP, F.lit(batch_stamp(moment)))


def append_history(rows: DataFrame, path: str) -> None:
    """Add stamped rows; stored ones are never changed.

    A day's rows come together before they are written, in tasks of the size that adaptive
    execution aims at: else each task would sort its share of all days, however large, and
    write a file a day.
    """
    day = F.to_date(F.col(STAMP))
    rows.withColumn(STAMP_DAY, day).hint("rebalance", STAMP_DAY).write.mode("append").partitionBy(STAMP_DAY).parquet(path)
