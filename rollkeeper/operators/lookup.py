"""Checks of a batch against code tables and owners, as set joins.

No broadcast hint is given for a code table: it is folded to one row per code and stored,
and Spark broadcasts it when its size is below the session's limit. Beyond that the rows of
a popular code are split over many tasks (see ``spread``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeeper.functions.compare import differs
from rollkeeper.operators.spread import balanced_join, spread_join
from rollkeeper.session import written

INSERT, UPDATE, NONE = "insert", "update", "none"


def lookup(
    df: DataFrame, value: str, table: DataFrame, key: str, returns: str, into: str, miss
) -> DataFrame:
    """``into`` = ``returns`` of the row whose ``key`` equals ``value``, else ``miss``."""
    codes = table.groupBy(F.col(key).alias("_code")).agg(F.min(returns).alias("_found"))
    return (
        balanced_join(df, value, codes, "_code")
        .withColumn(into, F.coalesce(F.col("_found"), F.lit(miss)))
        .drop("_found")
    )


def exists_in(df: DataFrame, value: str, table: DataFrame, key: str) -> DataFrame:
    """Rows whose ``value`` is a ``key`` of ``table``."""
    known = table.select(F.col(key).alias("_code"))
    return df.join(known, F.col(value) == F.col("_code"), "left_semi")


def missing_in(df: DataFrame, value: str, table: DataFrame, key: str) -> DataFrame:
    """Rows whose ``value`` is no ``key`` of ``table``, null included."""
    known = table.select(F.col(key).alias("_code"))
    return df.join(known, F.col(value) == F.col("_code"), "left_anti")


def needs_update(
    df: DataFrame, code: str, text: str, table: DataFrame, key: str, descr: str, into: str = "action"
) -> DataFrame:
    """``insert`` for an unknown code, ``update`` for another text, else ``none``."""
    codes = table.groupBy(F.col(key).alias("_code")).agg(
        F.min(descr).alias("_descr"), F.lit(True).alias("_known")
    )
    action = (
        F.when(F.col("_known").isNull(), INSERT)
        .when(differs(F.col("_descr"), F.col(text)), UPDATE)
        .otherwise(NONE)
    )
    return balanced_join(df, code, codes, "_code").withColumn(into, action).drop("_descr", "_known")


def held_by_other(
    df: DataFrame, value: str, me: str, holders: DataFrame, key: str, owner: str, into: str, miss=0
) -> DataFrame:
    """The smallest other owner of ``value``, or ``miss`` when nobody else holds it.

    Only the two smallest owners per value can be the answer: the smallest one,
    or the next one where the smallest is the row's own. Two grouped minima find
    them, so a value with many owners is never paired out.
    """
    held = holders.select(F.col(key).alias("_held"), F.col(owner).alias("_owner")).dropna()
    first = written(held.groupBy("_held").agg(F.min("_owner").alias("_first")), "first-owners")
    second = (
        spread_join(held, first, ["_held"], "inner", stored=True)
        .filter(F.col("_owner") > F.col("_first"))
        .groupBy("_held")
        .agg(F.min("_owner").alias("_second"))
    )
    owners = first.join(second, "_held", "left")
    other = F.when(F.col("_first") != F.col(me), F.col("_first")).otherwise(F.col("_second"))
    return (
        balanced_join(df, value, owners, "_held")
        .withColumn(into, F.coalesce(other, F.lit(miss)))
        .drop("_first", "_second")
    )


def known_supervisor(df: DataFrame, number: str, people: DataFrame, key: str, into: str) -> DataFrame:
    """The supervisor's number where it is a known one above zero, else 0."""
    known = people.select(F.col(key).try_cast("int").alias("_number")).filter("_number >= 1").distinct()
    asked = df.withColumn("_asked", F.col(number).try_cast("int"))
    found = balanced_join(asked, "_asked", known.withColumn("_known", F.col("_number")), "_number")
    return found.withColumn(into, F.coalesce(F.col("_known"), F.lit(0))).drop("_asked", "_known")


def warnings_for(df: DataFrame, checks: list[tuple[str, str, DataFrame, str]], keep: list[str]) -> DataFrame:
    """One row per failed check; the rows themselves go on.

    A check is (warning, value column, code table, key column).
    """
    found: DataFrame | None = None
    for warning, value, table, key in checks:
        rows = missing_in(df, value, table, key).select(
            *keep, F.lit(warning).alias("warning"), F.col(value).cast("string").alias("value")
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def text_of_position(df: DataFrame, key: str, jobs: DataFrame, jobs_key: str, title: str, into: str) -> DataFrame:
    """The job title recorded for a position; the smallest when there are several."""
    titles = jobs.groupBy(F.col(jobs_key).alias("_pos")).agg(F.min(title).alias("_title"))
    return (
        balanced_join(df, key, titles, "_pos")
        .withColumn(into, F.coalesce(F.col("_title"), F.lit("")))
        .drop("_title")
    )
