"""Row gates: an ordered list of reasons, the first that holds wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeeper.functions.dates import bad_feed_date
from rollkeeper.functions.text import blank_to_null, is_blank

REASON = "reject_reason"
SKIP = "skip:"

Rule = tuple[str, Column]


def judged(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds the first reason that holds, null for a row that passes. A reason the
    row already has stays."""
    if REASON in df.columns:
        rules = [(F.col(REASON), F.col(REASON).isNotNull()), *rules]
    first = F.when(rules[0][1], rules[0][0])
    reason = reduce(lambda chain, rule: chain.when(rule[1], rule[0]), rules[1:], first)
    return df.withColumn(REASON, reason)


def accepted(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(REASON).isNull()).drop(REASON)


def refused(marked: DataFrame) -> DataFrame:
    """Rows with a reason, skips too."""
    return marked.filter(F.col(REASON).isNotNull())


def rejected(marked: DataFrame) -> DataFrame:
    """Rows with a reason, skips left out."""
    return marked.filter(F.col(REASON).isNotNull() & ~F.col(REASON).startswith(SKIP))


def skipped(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col(REASON).startswith(SKIP)).drop(REASON)


def bad_date_rules(columns: list[str], names: list[str] | None = None) -> list[Rule]:
    """One rule per date column that holds unreadable text."""
    names = names or columns
    return [(f"bad_value:{n}", bad_feed_date(F.col(c))) for c, n in zip(columns, names)]


def blank_rule(reason: str, column: str) -> Rule:
    return reason, is_blank(F.col(column))


def empty_rule(reason: str, column: str) -> Rule:
    return reason, F.col(column) == ""


def route(df: DataFrame, column: str, code: str) -> tuple[DataFrame, DataFrame]:
    """Rows that carry ``code``, and all others (null included)."""
    hit = F.col(column).eqNullSafe(F.lit(code))
    return df.filter(hit), df.filter(~hit)


def filled(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) != "")


def not_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(~is_blank(F.col(column)))


def is_open(end: str = "end_date") -> Column:
    return F.col(end).isNull()


def is_active(as_of: Column, end: str = "end_date") -> Column:
    return F.col(end).isNull() | (F.col(end) > as_of)


def of_kinds(column: str, kinds: list[str]) -> Column:
    return F.col(column).isin(*kinds)


def first_filled_slot(
    df: DataFrame, slots: list[tuple[str, int, dict[str, str]]], key: str, rank: str
) -> DataFrame:
    """The first slot that holds a value, with its rank and its other columns.

    A slot is (value column, rank, {other column: name it gets}).
    """

    def packed(slot: tuple[str, int, dict[str, str]]) -> Column:
        column, number, others = slot
        values = [F.col(c).alias(n) for c, n in others.items()]
        full = F.struct(F.col(column).alias(key), F.lit(number).alias(rank), *values)
        return F.when(blank_to_null(F.col(column)).isNotNull(), full)

    used = {c for column, _, others in slots for c in (column, *others)}
    rest = [c for c in df.columns if c not in used]
    picked = df.withColumn("_slot", F.coalesce(*[packed(s) for s in slots]))
    return picked.filter(F.col("_slot").isNotNull()).select(*rest, "_slot.*")
