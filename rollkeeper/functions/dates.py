"""Dates: text only at the edges, ``date`` inside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings of a day at the edges.
FEED_DAY_SHAPE = "^[0-9]{1,2}/[0-9]{1,2}/(?!0000)[0-9]{4}$"
US_DAY = "MM/dd/yyyy"
ISO_DAY = "yyyy-MM-dd"


def feed_date(c: Column) -> Column:
    """``M/D/YYYY`` text to a date; blank or unreadable gives null.

    The parts are put in ISO order and cast, which is several times faster than a
    pattern parser and as strict about the calendar.
    """
    month = F.substring_index(c, "/", 1)
    day = F.substring_index(F.substring_index(c, "/", 2), "/", -1)
    year = F.substring_index(c, "/", -1)
    iso = F.concat_ws("-", year, month, day)
    return F.when(c.rlike(FEED_DAY_SHAPE), iso.try_cast("date"))


def bad_feed_date(c: Column) -> Column:
    """True where there is text that is no day of the calendar."""
    return (c != "") & feed_date(c).isNull()


def us_text(c: Column) -> Column:
    """A date as ``MM/DD/YYYY``, null as blank."""
    return F.coalesce(F.date_format(c, US_DAY), F.lit(""))


def iso_text(c: Column) -> Column:
    """A date as ``YYYY-MM-DD``, null as blank."""
    return F.coalesce(F.date_format(c, ISO_DAY), F.lit(""))


def normal_us_text(c: Column) -> Column:
    """``M/D/YYYY`` text to ``MM/DD/YYYY``; blank gives null."""
    return F.date_format(feed_date(c), US_DAY)


def next_day(c: Column) -> Column:
    return F.date_add(c, 1)


def age_years(born: Column, day: Column) -> Column:
    """Whole years at ``day``; the birthday itself counts."""
    before_birthday = (F.month(day) < F.month(born)) | (
        (F.month(day) == F.month(born)) & (F.dayofmonth(day) < F.dayofmonth(born))
    )
    return F.year(day) - F.year(born) - before_birthday.cast("int")
