"""Pick one row per key by a stated order; both passes combine map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeeper.functions.compare import fingerprint
from rollkeeper.operators.places import PLACE, at_places
from rollkeeper.operators.spread import spread_join
from rollkeeper.session import written

CONFLICT = "conflict_in_batch"


def pick_one(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row with the smallest ``order`` per key."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def newest(df: DataFrame, keys: list[str], stamp: str) -> DataFrame:
    """Per key the newest stamp, e.g. the newest begin date of a person and kind."""
    return df.groupBy(*keys).agg(F.max(stamp).alias(stamp))


def one_per_key(df: DataFrame, keys: list[str], latest_by: str) -> tuple[DataFrame, DataFrame]:
    """Split a batch into one winner per key and the losers.

    The winner is the row with the latest ``latest_by``, ties broken by the row
    fingerprint; equal rows count as one. Rows with the same key and another
    fingerprint are the losers.

    The latest day of each key and how many rows it has come from narrow grouped counts,
    folded map-side; the join with them splits a hot key. The rows are stored with what the
    join tells of them. So most are settled by their day alone: whole rows are hashed and
    sorted only where a key has several on its latest day. ``df`` is read twice, so it
    should be a stored table or cheap to read. Of rows with places (``places.placed``) only
    keys, days and places are joined and stored, and the rows are picked by their places.
    """
    columns = [c for c in df.columns if c != PLACE]
    days = df.groupBy(*keys, F.col(latest_by).alias("_by")).agg(F.count(F.lit(1)).alias("_n"))
    top = days.groupBy(*keys).agg(F.max("_by").alias("_top"), F.max_by("_n", "_by").alias("_n"))
    first = F.col(latest_by).eqNullSafe(F.col("_top"))
    # without any day all rows of a key may be equal to each other
    several = F.col("_top").isNull() | (F.col("_n") > 1)
    flags = [first.alias("_first"), (first & several).alias("_tied")]
    if PLACE in df.columns:
        marked = spread_join(df.select(*dict.fromkeys([*keys, latest_by, PLACE])), top, keys, "inner")
        marked = written(marked.select(PLACE, *flags), "marked")

        def rows(which: str) -> DataFrame:
            return at_places(df, marked.filter(which)).select(*columns)
    else:
        marked = written(spread_join(df, top, keys, "inner").select(*columns, *flags), "marked")

        def rows(which: str) -> DataFrame:
            return marked.filter(which).select(*columns)

    tied = rows("_tied").withColumn("_fp", fingerprint(*[F.col(c) for c in columns]))
    best = tied.groupBy(*keys).agg(F.max(F.struct("_fp", F.struct(*columns).alias("_row"))).alias("_best"))
    best = written(best, "best")
    won = rows("_first and not _tied").unionByName(best.select("_best._row.*"))
    beaten = spread_join(tied, best.select(*keys, F.col("_best._fp").alias("_best_fp")), keys, "inner", stored=True)
    return won, rows("not _first").unionByName(beaten.filter(F.col("_fp") != F.col("_best_fp")).select(*columns))
