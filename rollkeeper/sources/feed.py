"""The feed: wide CSV files in a drop folder."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeeper.contract import CORRUPT, Contract
from rollkeeper.operators.gate import REASON
from rollkeeper.sources.quoted import FILE, quotes_in, read_quoted

SHORT_ROW = "short_row"
SOURCE = "source_file"
#: Rows of a packed file; some 350 MB of text at the width of the people feed.
PACKED_ROWS = 200_000


BROKEN_LINE = "a quoted value holds a line break; read the feed with quoted_lines=True"


def read_csv(spark: SparkSession, path: str | list[str], columns: list[str], multi_line: bool = False) -> DataFrame:
    """Quoted CSV as text, blank for empty, plus the raw text of uneven rows.

    Files are cut into tasks of any size. A value that holds a line break is then an
    error, as one of its pieces is an uneven row with an odd number of quotes. With
    ``multi_line`` such values are read, at the price of one task per file; ``read_quoted``
    reads them by as many tasks as a file is large.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = (
        spark.read.schema(schema.add(CORRUPT, T.StringType()))
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)  # else a row counts as uneven by the columns asked for
        .csv(path)
        .na.fill("", subset=columns)
    )
    if multi_line:
        return rows
    broken = F.raise_error(F.lit(BROKEN_LINE)).cast("string")
    return rows.withColumn(CORRUPT, F.when(quotes_in(F.col(CORRUPT)) % 2 == 1, broken).otherwise(F.col(CORRUPT)))


def headers_by_file(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Header -> the files that begin with it. One row per file comes to the driver."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
        "value",
    )
    found: dict[tuple[str, ...], list[str]] = {}
    for row in lines.groupBy("file").agg(F.min_by("value", "at").alias("head")).orderBy("file").collect():
        header = next(csv.reader([row["head"].lstrip("\ufeff")]), [])
        found.setdefault(tuple(header), []).append(row["file"])
    return found


def field_count(raw: Column) -> Column:
    """Number of comma-separated fields; commas in quotes do not count."""
    bare = F.regexp_replace(raw, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_feed(
    spark: SparkSession, path: str | list[str], contract: Contract, multi_line: bool = False, quoted_lines: bool = False
) -> DataFrame:
    """All files of a drop folder under the contract's short names.

    Columns are found by each file's header, whatever their order; a missing one in any
    file is an error before any row is read. A row that lacks more than its last column
    is marked ``short_row`` in ``reject_reason``; a row that is too long is kept.
    Values with line breaks are read with ``quoted_lines``, by several tasks a file.
    """
    by_header = headers_by_file(spark, path)
    for header in by_header:
        contract.check_headers(list(header))

    def one(header: tuple[str, ...], files: list[str]) -> DataFrame:
        if quoted_lines:
            raw, source = read_quoted(spark, files, list(header)), F.col(FILE)
        else:
            raw, source = read_csv(spark, files, list(header), multi_line), F.input_file_name()
        short = F.col(CORRUPT).isNotNull() & (field_count(F.col(CORRUPT)) < len(header) - 1)
        return raw.select(
            *[F.col(f"`{f.header}`").alias(f.name) for f in contract.fields],
            F.when(short, SHORT_ROW).alias(REASON),
            source.alias(SOURCE),
        )

    if not by_header:
        raise ValueError(f"no feed file with a header at {path}")
    return reduce(DataFrame.unionByName, [one(h, files) for h, files in by_header.items()])


def write_csv(df: DataFrame, path: str, packed: bool = False) -> None:
    """CSV with every field quoted and blanks kept.

    ``packed`` files are gzip, which a reader sees by their names. Each is read by one task,
    so none holds more than ``PACKED_ROWS`` rows.
    """
    out = (
        df.write.option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if packed:
        out = out.option("compression", "gzip").option("maxRecordsPerFile", PACKED_ROWS)
    out.csv(path)


def write_feed(df: DataFrame, path: str, contract: Contract) -> None:
    """Cleaned rows under the provider's headers."""
    write_csv(contract.to_feed(df), path)


def write_difference(df: DataFrame, path: str, contract: Contract) -> None:
    """New and changed rows under the short names, packed: 91 quoted columns mostly repeat each other."""
    texts = contract.to_feed(df)
    write_csv(texts.select(*[F.col(f"`{f.header}`").alias(f.name) for f in contract.fields]), path, packed=True)
