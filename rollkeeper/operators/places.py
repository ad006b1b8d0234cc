"""Rows of a stored wide table picked by their place: what decides is dealt out, the rows stay where they lie.

A place is a number that is stored with the row. The places that are picked become one bit
for each row of the table, in words of 4 KB for 32,768 places, and the table is read past
these. A broadcast of them is left to Spark, which knows their size: a hundred million rows
have some 12 MB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeeper.session import written

PLACE = "_place"


def placed(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored, with the place of each row."""
    return written(df.withColumn(PLACE, F.monotonically_increasing_id()), name)


def _is_set(bits: Column, place: Column) -> Column:
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, at.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


def at_places(df: DataFrame, places: DataFrame) -> DataFrame:
    """The rows of ``df``, a table made by ``placed``, whose place is in ``places``."""
    word = F.bitmap_bucket_number(F.col(PLACE))
    picked = places.select(word.alias("_word"), F.bitmap_bit_position(F.col(PLACE)).alias("_bit")).repartition("_word")
    words = written(picked.groupBy("_word").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "places")
    return df.join(words, word == F.col("_word")).filter(_is_set(F.col("_bits"), F.col(PLACE))).drop("_word", "_bits")
