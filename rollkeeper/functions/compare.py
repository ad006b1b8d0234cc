"""Three rules for null against blank, kept apart by name, and row fingerprints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def same_or_both_blank(a: Column, b: Column) -> Column:
    """Snapshot rule: null and blank are one value."""
    return F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit(""))


def stored_equals(a: Column, b: Column, is_date: bool = False) -> Column:
    """Verify rule: null meets null for dates only; a null text equals nothing."""
    return a.eqNullSafe(b) if is_date else a == b


def differs(a: Column, b: Column) -> Column:
    """Row-compare rule: null is a value of its own, unlike blank."""
    return ~a.eqNullSafe(b)


def any_differs(pairs: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda x, y: x | y, [differs(a, b) for a, b in pairs])


def number_key(c: Column) -> Column:
    """Text that holds a number compares as that number: leading zeros do not count."""
    return F.coalesce(c.try_cast("bigint").cast("string"), c.cast("string"))


def fingerprint(*columns: Column, null_marks: list[str] | None = None) -> Column:
    """One binary key for a whole row. Each value carries its length, null its own
    mark (``null_marks``, one per column), so two rows share a key only if all their
    columns are equal. The key is declared non-null: a join on it then needs no null
    check over every column, which Catalyst would carry through each projection."""
    parts = []
    for c, mark in zip(columns, null_marks or ["-"] * len(columns)):
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(value), F.lit(":"), value), F.lit(mark)))
    return F.coalesce(F.unhex(F.sha2(F.concat_ws(",", *parts), 256)), F.lit(b""))


#: Stands between the values of a row in ``joined_key``; a row whose values hold it is marked.
BETWEEN = "\x1f"


def joined_key(values: list[Column]) -> Column:
    """One binary key for a row of texts; null if one of them is null. Two rows share a key
    only if all their texts are equal.

    The texts are put one behind the other, which costs a fraction of a length for each. Where
    a text holds what stands between them, the lengths of all are put in front, behind more
    marks than a row without has.
    """
    parts = [p for v in values for p in (F.lit(BETWEEN), v)][1:]
    text = F.concat(*parts)
    plain = F.substring_index(text, BETWEEN, len(values)) == text
    lengths = F.concat_ws(",", *[F.octet_length(v).cast("string") for v in values])
    marked = F.concat(F.lit(BETWEEN * len(values)), lengths, F.lit(BETWEEN), text)
    return F.unhex(F.sha2(F.when(plain, text).otherwise(marked), 256))
