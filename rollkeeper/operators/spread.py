"""Joins that stay balanced when some keys hold most of the rows.

The side that is unique on the keys is stored first. So Spark knows its size: a small one
is broadcast, which leaves the other side where it lies. Otherwise both sides are shuffled
just as they are read, and adaptive execution cuts every partition that a hot key has
swollen into tasks of a stated size, however many hot keys there are. (An aggregate as the
right side would forbid that.) Nothing here depends on a number of keys or rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeeper.session import written


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, stored: bool = False) -> DataFrame:
    """Null-safe equi-join of a skewed ``left`` with a ``right`` unique on ``keys``.

    ``stored``: ``right`` is read from files as it is.
    """
    right = right if stored else written(right, "right-side")
    for k in keys:
        right = right.withColumnRenamed(k, f"_right_{k}")
    on = [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys]
    joined = left.join(right, reduce(lambda a, b: a & b, on), how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def balanced_join(df: DataFrame, value: str, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``df`` with the columns that ``right``, unique on ``key``, holds for its ``value``.

    A null value finds nothing.
    """
    known = written(right.filter(F.col(key).isNotNull()), "right-side").withColumnRenamed(key, "_key")
    return df.join(known, F.col(value) == F.col("_key"), how).drop("_key")


def narrowed(state: DataFrame, key: str, asked: DataFrame) -> DataFrame:
    """Rows of ``state`` with a key that the stored table ``asked`` holds."""
    known = asked.withColumnRenamed(asked.columns[0], "_asked")
    return state.join(known, F.col(key) == F.col("_asked"), "left_semi")
