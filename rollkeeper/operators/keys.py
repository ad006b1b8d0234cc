"""Generated keys for new rows, numbered in the order of their natural key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollkeeper.session import written

#: monotonically_increasing_id: the partition above, the row within it below.
PLACE_BITS = 33


def assign_keys(df: DataFrame, natural: list[str], key: str, start: int, ranges: int | None = None) -> DataFrame:
    """``key`` = ``start`` + rank of the natural key, which must be unique in ``df``.

    Rows are cut into ranges of the natural key by Spark's range partitioning (as many
    as a shuffle has, unless given), sorted inside, and stored with their place. A row's
    number is its place in its range plus the rows of the ranges before: one count per
    range, added up in a window over that small table. ``df`` is read twice, so it
    should be a stored table.
    """
    parts = df.repartitionByRange(ranges, *natural) if ranges else df.repartitionByRange(*natural)
    placed = parts.sortWithinPartitions(*natural).withColumn("_place", F.monotonically_increasing_id())
    placed = written(placed.withColumn("_range", F.shiftright("_place", PLACE_BITS)), "ranges")
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    shifts = written(counts.select("_range", before.alias("_before")), "range-counts")
    inside = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    number = F.lit(int(start) + 1) + F.col("_before") + inside
    types = {f.name: f.dataType for f in df.schema}
    numbered = placed.join(shifts, "_range").withColumn(key, number.cast(types.get(key, "bigint")))
    return numbered.select(*df.columns, *([] if key in types else [key]))
