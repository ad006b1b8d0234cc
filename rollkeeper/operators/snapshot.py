"""Newest recorded state, difference of two snapshots, and the seen-before check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollkeeper.functions.compare import fingerprint, joined_key, number_key
from rollkeeper.operators.pick import pick_one
from rollkeeper.operators.spread import spread_join
from rollkeeper.session import written

#: A row's fingerprint in the difference, and its key in the seen-before check. A table that
#: holds them already may lack the columns that they stand for.
FINGERPRINT, SEEN = "_fp", "_seen"


def _on_days(df: DataFrame, stamps: DataFrame, stamp: str, day: str) -> tuple[DataFrame, DataFrame]:
    """``df`` from the first day that counts on, and ``stamps`` with the days under which rows of theirs lie.

    The filter on the stamps makes Spark look for the days at run time (dynamic partition
    pruning), so the wide rows of other days are not read.
    """
    days = written(df.groupBy(stamp, day).agg(F.lit(True).alias("_in")).drop("_in"), "stamp-days")
    pairs = written(days.join(stamps, [stamp]), "newest-days")
    first = pairs.agg(F.min(day)).first()[0]
    if first is None:
        return df.limit(0), pairs
    since = F.col(day) >= F.lit(first)
    return df.filter(since), pairs.filter(since)


def latest_snapshot(
    df: DataFrame, keys: list[str], stamp: str, mode: str = "stamp_in", day: str | None = None
) -> DataFrame:
    """Rows of the newest recorded state.

    ``day``: the column by which the files of ``df`` are partitioned; days that hold no
    newest row are then skipped, whatever the mode.

    ``stamp_in``: the row's stamp is the newest stamp of *any* key.
    ``per_key``: the row's stamp is the newest stamp of its own key.
    ``single``: one row per key, the newest, ties broken by the row itself.
    """
    if mode == "single":
        rest = [c for c in df.columns if c not in keys and c != stamp]
        order = F.struct((-F.unix_micros(F.col(stamp).cast("timestamp"))).alias("t"), *rest)
        return pick_one(df, keys, order)
    top = df.groupBy(*keys).agg(F.max(stamp).alias(stamp)).filter(F.col(stamp).isNotNull())
    if mode not in ("stamp_in", "per_key"):
        raise ValueError(f"unknown mode: {mode}")
    if day is not None:
        top = written(top, "newest-stamps")
        df, pairs = _on_days(df, top.select(stamp).distinct(), stamp, day)
        df = df.join(pairs.select(day, stamp), [day, stamp], "left_semi")
        if mode == "stamp_in":
            return df
    if mode == "stamp_in":
        # With one stamp per batch they are a small file that Spark broadcasts, and
        # the wide history is not shuffled at all.
        stamps = top.select(stamp).distinct()
        return spread_join(df.filter(F.col(stamp).isNotNull()), stamps, [stamp], "left_semi")
    return spread_join(df, top, [*keys, stamp], "left_semi", stored=day is not None)


def row_fingerprint(values: list[Column], blank_is_null: bool = False) -> Column:
    """The fingerprint of a row of these values."""
    if not blank_is_null:
        return fingerprint(*values)
    return F.coalesce(joined_key([F.coalesce(c.cast("string"), F.lit("")) for c in values]), F.lit(b""))


def with_row_fingerprint(df: DataFrame, names: list[str], blank_is_null: bool = False) -> DataFrame:
    """``df`` with the fingerprint ``_fp`` of these columns, unless it holds one."""
    if FINGERPRINT in df.columns:
        return df
    return df.withColumn(FINGERPRINT, row_fingerprint([F.col(c) for c in names], blank_is_null))


def _once(marked: DataFrame) -> DataFrame:
    """One row of each fingerprint, without it.

    A row is carried as one value: an aggregate with a buffer for each of some ninety columns
    takes several times as long.
    """
    row = F.struct(*[c for c in marked.columns if c != FINGERPRINT])
    return marked.groupBy(FINGERPRINT).agg(F.first(row).alias("_row")).select("_row.*")


def snapshot_diff(new: DataFrame, old: DataFrame, blank_is_null: bool = False) -> DataFrame:
    """Rows of ``new`` that are not in ``old``, without repeats.

    Rows meet on a fingerprint, so the join carries one narrow key instead of every
    column. Known rows drop out first; repeats are folded among the few that are left,
    in the same partitioning.
    """
    known = with_row_fingerprint(old, new.columns, blank_is_null).select(FINGERPRINT).distinct()
    marked = with_row_fingerprint(new, new.columns, blank_is_null)
    return _once(marked.join(known, FINGERPRINT, "left_anti"))


def snapshot_diff_kept(new: DataFrame, kept: DataFrame, blank_is_null: bool = False) -> DataFrame:
    """``snapshot_diff`` against the kept fingerprints of the old state (``sources.kept``).

    These lie in buckets, so only the new side is dealt out, and the old rows are neither
    read nor hashed again.
    """
    marked = with_row_fingerprint(new, new.columns, blank_is_null)
    return _once(marked.join(kept, FINGERPRINT, "left_anti"))


def drop_repeats(df: DataFrame) -> DataFrame:
    """Equal rows once, folded before the shuffle."""
    return df.distinct()


def seen_key(values: dict[str, Column], texts: set[str], dates: list[str], numbers: list[str]) -> Column:
    """The key on which a row meets its like in the seen-before check; null if a value that
    equals nothing is null, so that the row meets none."""

    def value(c: str) -> Column:
        if c in numbers:
            return number_key(values[c])
        text = F.rtrim(values[c]) if c in texts else values[c].cast("string")
        return F.coalesce(text, F.lit("-")) if c in dates else text

    return joined_key([value(c) for c in values])


def not_in_latest(
    candidates: DataFrame, latest: DataFrame, columns: list[str], dates: list[str], numbers: list[str]
) -> DataFrame:
    """Candidates that equal no row of ``latest`` in all ``columns``.

    Columns in ``dates`` treat null and null as equal, columns in ``numbers``
    compare as numbers, and in all others a null equals nothing. Trailing blanks of a text
    do not count.
    """
    texts = {f.name for f in latest.schema if isinstance(f.dataType, T.StringType)}

    def key(df: DataFrame) -> DataFrame:
        if SEEN in df.columns:
            return df
        return df.withColumn(SEEN, seen_key({c: F.col(c) for c in columns}, texts, dates, numbers))

    known = key(latest).select(SEEN).distinct()
    return key(candidates).join(known, SEEN, "left_anti").drop(SEEN)
