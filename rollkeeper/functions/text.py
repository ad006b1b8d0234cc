"""Text clean-up as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim(c: Column) -> Column:
    """Drop blanks on both sides (blanks only, not tabs or line breaks)."""
    return F.trim(c)


def cut(c: Column, n: int) -> Column:
    """The first ``n`` characters."""
    return F.substring(c, 1, n)


def zero_pad(c: Column, n: int) -> Column:
    """Zeros on the left up to ``n`` characters; a sign stays in front; never cuts."""
    signed = F.concat(F.substring(c, 1, 1), F.lpad(F.substring(c, 2, n), n - 1, "0"))
    return (
        F.when(F.length(c) >= n, c)
        .when(c.startswith("-") | c.startswith("+"), signed)
        .otherwise(F.lpad(c, n, "0"))
    )


def phone(c: Column) -> Column:
    """``ddd-ddd-dddd``; short input leaves empty parts, blank or null gives blank."""
    digits = F.translate(c, "() -", "")
    parts = [F.substring(digits, start, size) for start, size in ((1, 3), (4, 3), (7, 4))]
    return F.when(c.isNull() | (c == ""), "").otherwise(F.concat_ws("-", *parts))


def location(building: Column, room: Column) -> Column:
    """Building and room as one text; a missing part leaves no gap."""
    return F.concat_ws(" ", building, room)


def position_key(pay: Column, unit: Column, dept: Column, title: Column) -> Column:
    """Composite position key: pay code, unit (4), department (3), title."""
    return F.concat_ws("-", pay, cut(unit, 4), cut(dept, 3), title)


def split_position_key(c: Column) -> Column:
    """The four parts of a position key, or null when there are fewer than four."""
    parts = F.split(c, "-", 4)
    names = ("pay", "unit", "dept", "title")
    return F.when(
        F.size(parts) == 4, F.struct(*[F.get(parts, i).alias(n) for i, n in enumerate(names)])
    )


def supervisor_number(c: Column) -> Column:
    """The employee number inside a supervisor id: characters 4 to 10."""
    return F.substring(c, 4, 7)


def title_key(c: Column) -> Column:
    """A salutation without dots, in upper case."""
    return F.upper(F.replace(c, F.lit("."), F.lit("")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_to_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")
