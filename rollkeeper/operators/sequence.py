"""Folds over the rows of a key in their order, whatever number of rows a key has.

Rows are cut into ranges of (key, order) by Spark's range partitioning and stored with their
place. Windows run inside one range of one key only. Keys that go over a range's edge, at
most one an edge, get what the ranges before have come to from a small table with one row
for each range and such key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollkeeper.operators.keys import PLACE_BITS
from rollkeeper.session import written

RANGE, PLACE = "_range", "_place"


def placed(df: DataFrame, keys: list[str], order: list[str], ranges: int | None = None) -> DataFrame:
    """``df`` sorted by key and order, stored with each row's range and place in the whole."""
    by = [*keys, *order]
    parts = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    rows = parts.sortWithinPartitions(*by).withColumn(PLACE, F.monotonically_increasing_id())
    return written(rows.withColumn(RANGE, F.shiftright(PLACE, PLACE_BITS)), "placed")


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    named = right.select(*[F.col(k).alias(f"_at_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in keys])
    return left.join(named, same, how).drop(*[f"_at_{k}" for k in keys])


def _over_edges(rows: DataFrame, keys: list[str], facts: list[Column], carried: list[Column]) -> DataFrame:
    """For each range of a key that lies in several: ``carried``, windows over its ranges' ``facts``. Stored."""
    each = rows.groupBy(*keys, RANGE).agg(*facts)
    several = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    return written(each.withColumn("_several", several).filter("_several").select(*keys, RANGE, *carried), "over-edges")


def _before(keys: list[str]):
    return Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)


def previous(rows: DataFrame, keys: list[str], column: str, into: str, first: str) -> DataFrame:
    """``into``: the value of ``column`` in the row before; ``first``: whether there is none. ``rows`` is placed."""
    inside = Window.partitionBy(*keys, RANGE).orderBy(PLACE)
    value = F.struct(F.col(column).alias("v"))
    last = F.max_by(value, PLACE).alias("_last")
    edges = _over_edges(rows, keys, [last], [F.last("_last", ignorenulls=True).over(_before(keys)).alias("_carried")])
    near = rows.withColumn("_near", F.lag(value).over(inside))
    joined = _null_safe(near, edges, [*keys, RANGE])
    found = F.coalesce("_near", "_carried")
    return joined.withColumn(into, found["v"]).withColumn(first, found.isNull()).drop("_near", "_carried")


def running(rows: DataFrame, keys: list[str], value: Column, how: str, into: str) -> DataFrame:
    """``into``: the ``sum`` or ``max`` of ``value`` over a key's rows up to this one. ``rows`` is placed."""
    fold = {"sum": F.sum, "max": F.max}[how]
    both = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest}[how]
    inside = Window.partitionBy(*keys, RANGE).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_folded", value)
    edges = _over_edges(rows, keys, [fold("_folded").alias("_all")], [fold("_all").over(_before(keys)).alias("_carried")])
    joined = _null_safe(rows.withColumn("_near", fold("_folded").over(inside)), edges, [*keys, RANGE])
    return joined.withColumn(into, both(F.col("_near"), F.col("_carried"))).drop("_folded", "_near", "_carried")
