"""All code checks of a batch in one pass.

The code tables are folded to one dictionary of (table, code) with a text for each code. The
batch is read once for its distinct codes, whatever the number of checks, and each is judged
once. What comes back to the rows is one join for each column that holds codes, however many
tables it is checked against. Codes are compared as text; a null code is never known.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeeper.session import written


@dataclass(frozen=True)
class Check:
    """The codes in ``column`` against ``key`` of a table; ``text`` is what the table says of a code."""

    table: str
    column: str
    key: str
    text: str | None = None

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}"


def dictionary(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(table, code, text): each code of each table that is checked, the smallest text if there are several."""
    out = None
    for table, key, text in dict.fromkeys((c.table, c.key, c.text) for c in checks):
        said = F.col(text).cast("string") if text else F.lit(None).cast("string")
        rows = tables[table].select(F.lit(table).alias("table"), F.col(key).cast("string").alias("code"), said.alias("text"))
        out = rows if out is None else out.unionByName(rows)
    return out.filter(F.col("code").isNotNull()).groupBy("table", "code").agg(F.min("text").alias("text"))


def code_judgements(df: DataFrame, tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(table, code, known, text): each distinct code that ``df`` has, judged once; stored."""
    asked = [F.struct(F.lit(c.table).alias("table"), F.col(c.column).cast("string").alias("code")) for c in checks]
    codes = df.select(F.explode(F.array(*asked)).alias("_c")).select("_c.*").distinct()
    known = written(dictionary(tables, checks), "codes").withColumn("_known", F.lit(True))
    judged = codes.join(known, ["table", "code"], "left")
    return written(judged.select("table", "code", F.coalesce("_known", F.lit(False)).alias("known"), "text"), "judged")


def with_judgements(df: DataFrame, judged: DataFrame, checks: list[Check]) -> DataFrame:
    """``df`` with a column ``<table>.<column>`` for each check: a struct of ``known`` and ``text``."""
    by_column: dict[str, list[Check]] = {}
    for c in checks:
        by_column.setdefault(c.column, []).append(c)
    for column, own in by_column.items():
        said = [F.max(F.when(F.col("table") == c.table, F.struct("known", "text"))).alias(c.name) for c in own]
        facts = judged.filter(F.col("table").isin([c.table for c in own])).groupBy(F.col("code").alias("_code")).agg(*said)
        df = df.join(written(facts.filter(F.col("_code").isNotNull()), "facts"), F.col(column).cast("string") == F.col("_code"), "left").drop("_code")
    return df


def is_known(check: Check) -> Column:
    return F.coalesce(F.col(f"`{check.name}`.known"), F.lit(False))


def text_for(check: Check, miss: str = "") -> Column:
    return F.coalesce(F.col(f"`{check.name}`.text"), F.lit(miss))


def judged_warnings(df: DataFrame, tables: dict[str, DataFrame], checks: dict[str, Check], keep: list[str]) -> DataFrame:
    """One row per failed check (warning -> check), like ``lookup.warnings_for``, with one join per column."""
    own = list(checks.values())
    marked = with_judgements(df, code_judgements(df, tables, own), own)
    failed = [
        F.when(~is_known(c), F.struct(F.lit(warning).alias("warning"), F.col(c.column).cast("string").alias("value")))
        for warning, c in checks.items()
    ]
    rows = marked.select(*keep, F.explode(F.array_compact(F.array(*failed))).alias("_w"))
    return rows.select(*keep, "_w.warning", "_w.value")
