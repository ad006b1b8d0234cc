"""Quoted CSV whose values may hold line breaks, cut into tasks of any size.

A file range alone can't tell whether it begins inside a quoted value. So every task counts
the quotes of its lines, and the ranges' counts, added up in the order of the file, tell
each range whether it begins inside a value and how many records end before it. With that
every line knows its record. Lines that are a whole record, nearly all of them, stay as they
are; only those of records of several lines are put together.

Doubled quotes count twice and change nothing. Line ends may be LF or CRLF; inside a value
both become LF. Empty lines between records are none. A file whose quotes don't pair up, or a
record of more than ``MOST_LINES`` lines (a stray quote swallows what follows), is an error
that names the file, raised before any row is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeeper.contract import CORRUPT
from rollkeeper.session import written

MOST_LINES = 10_000
FILE = "_file"


class UnevenQuotes(ValueError):
    """A feed file with a quote too many or too few."""


def quotes_in(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit('"'), F.lit("")))


def file_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of all files: file, where its range begins, place in it, text, and whether its quotes are odd."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("place"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )
    return lines.withColumn("odd", quotes_in(F.col("line")) % 2 == 1)


def _running(inside) -> Column:
    return F.sum(F.col("odd").cast("long")).over(inside)


def range_starts(lines: DataFrame) -> DataFrame:
    """For each range whether it begins inside a value (``open``) and the number of its first record.

    The lines of a range are counted in their order, without their text (a range is no
    larger than a task's read); then one row per range is added up over its file. Stored.
    """
    inside = Window.partitionBy(FILE, "range").orderBy("place")
    rows = lines.select(FILE, "range", "place", "odd").withColumn("odds", _running(inside))
    # a record ends with a line after which the quotes pair up
    even = F.col("odds") % 2 == 0
    ranges = rows.groupBy(FILE, "range").agg(
        F.sum(F.col("odd").cast("long")).alias("total"),
        F.count_if(even).alias("even_ends"),
        F.count_if(~even).alias("odd_ends"),
    )
    before = Window.partitionBy(FILE).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("open", F.coalesce(F.sum("total").over(before), F.lit(0)) % 2 == 1)
    ranges = ranges.withColumn("ends", F.when(F.col("open"), F.col("odd_ends")).otherwise(F.col("even_ends")))
    ranges = ranges.withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    ranges = written(ranges.select(FILE, "range", "open", "first", "total"), "feed-ranges")
    uneven = ranges.groupBy(FILE).agg(F.sum("total").alias("total")).filter("total % 2 = 1").orderBy(FILE).first()
    if uneven is not None:
        raise UnevenQuotes(f"quotes don't pair up in {uneven[FILE]}")
    return ranges.drop("total")


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with the number of each one's record in its file, and whether it is all of it."""
    inside = Window.partitionBy(FILE, "range").orderBy("place")
    rows = lines.withColumn("odds", _running(inside)).join(range_starts(lines), [FILE, "range"])
    odds = F.col("odds") + F.col("open").cast("long")
    rows = rows.withColumn("closes", odds % 2 == 0).withColumn("whole", F.col("closes") & ~F.col("odd"))
    record = F.col("first") + F.count_if(F.col("closes")).over(inside) - F.col("closes").cast("long")
    return rows.withColumn("record", record).select(FILE, "range", "place", "line", "record", "whole")


def records(spark: SparkSession, path: str | list[str], most_lines: int = MOST_LINES) -> DataFrame:
    """The records of all files but their headers, as text: file, record."""
    lines = written(numbered_lines(file_lines(spark, path)), "feed-records")
    whole = lines.filter("whole and record > 0 and line <> ''").select(FILE, F.col("line").alias("text"))
    parts = lines.filter("not whole")
    long = parts.groupBy(FILE, "record").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most_lines)
    first = long.orderBy(FILE, "record").first()
    if first is not None:
        raise UnevenQuotes(f"record {first['record']} of {first[FILE]} has {first['n']} lines; a quote may be missing")
    joined = parts.groupBy(FILE, "record").agg(F.array_sort(F.collect_list(F.struct("range", "place", "line"))).alias("parts"))
    text = F.array_join(F.col("parts.line"), "\n")
    return whole.unionByName(joined.filter("record > 0").select(FILE, text.alias("text")))


def read_quoted(spark: SparkSession, path: str | list[str], columns: list[str], most_lines: int = MOST_LINES) -> DataFrame:
    """Files of one header as ``columns``, blank for empty, the raw text of uneven rows, and the file."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]).add(CORRUPT, T.StringType())
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)
    options = {"escape": '"', "columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    rows = records(spark, path, most_lines)
    parsed = rows.select(FILE, F.from_csv("text", F.lit(ddl), options).alias("row"))
    return parsed.select("row.*", FILE).na.fill("", subset=columns)
