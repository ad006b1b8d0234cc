"""Code maps and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code maps of the feed and of the target tables.
HISPANIC_FLAGS = {
    "Not Hispanic or Latino": "N",
    "Hispanic or Latino": "Y",
}
RACE_CODES = {
    "1": "WH",
    "2": "BL",
    "4": "AS",
    "5": "AM",
    "6": "AP",
    "9": "MU",
}
RACE_TEXT_CODES = {
    "White (United States of America)": "WH",
    "Asian (United States of America)": "AS",
    "Black or African American (United States of America)": "BL",
    "Two or More Races (United States of America)": "MU",
    "American Indian or Alaska Native (United States of America)": "AM",
    "Native Hawaiian or Other Pacific Islander (United States of America)": "IS",
}
BUILDINGS = {
    "1": "LH",
    "2": "CC",
    "3": "DSC",
    "4": "HL",
    "5": "JAC",
    "6": "TWC",
    "7": "TC",
    "11": "MADR",
    "15": "SC",
    "16": "TA",
}
STUDENT_PAY_CODE = "DPW"


def map_code(c: Column, codes: dict[str, str], miss: str | None = "") -> Column:
    """Look ``c`` up in a small fixed map; ``miss`` where it is not listed."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    found = F.element_at(F.create_map(*pairs), c)
    return found if miss is None else F.coalesce(found, F.lit(miss))


def hispanic_flag(c: Column) -> Column:
    return map_code(c, HISPANIC_FLAGS)


def race_code(c: Column) -> Column:
    return map_code(c, RACE_CODES)


def race_text_code(c: Column) -> Column:
    return map_code(c, RACE_TEXT_CODES)


def building(c: Column) -> Column:
    """Building of a location number, null when unknown."""
    return map_code(c, BUILDINGS, miss=None)


def flag_or_no(c: Column) -> Column:
    """A missing flag counts as ``N``."""
    return F.coalesce(c, F.lit("N"))


def primary_rank(c: Column) -> Column:
    """``Yes`` is rank 1, ``No`` is rank 2, anything else has none."""
    return F.when(c == "Yes", 1).when(c == "No", 2)


def is_tenured(category: Column) -> Column:
    return F.when(category == "T", "Y").otherwise("N")


def is_tenure_track(category: Column) -> Column:
    return F.when(category == "TE", "Y").otherwise("N")
