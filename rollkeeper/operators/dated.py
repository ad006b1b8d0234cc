"""Dated contact rows: one open row per person and kind, older ones end-dated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeeper.functions.compare import differs
from rollkeeper.functions.dates import next_day
from rollkeeper.operators.changes import END, INSERT, NONE, UPDATE, change, emit, row_after, row_type
from rollkeeper.operators.gate import is_open, of_kinds
from rollkeeper.operators.sequence import placed, previous, running
from rollkeeper.operators.spread import spread_join
from rollkeeper.session import written

# Kinds of contact rows, and what every new one carries.
PREVIOUS = "PREV"
CELL = "CELL"
PRIVATE_EMAIL = "EML2"
WORK_EMAIL = "EML3"
DIRECTORY = "SCHL"
ADDRESS_KINDS = ["PERM", "PREV", "SCND"]
NEW_CONTACT = {
    "peren": "N",
    "end_date": None,
    "line1": "",
    "line2": "",
    "line3": "",
    "city": "",
    "st": "",
    "zip": "",
    "ctry": "",
    "phone": "",
    "phone_ext": "",
    "ofc_add_by": "HR",
    "cell_carrier": "",
    "opt_out": "",
}
ADDRESS = ["line1", "line2", "line3", "city", "st", "zip", "ctry", "phone"]


def new_contact(state: DataFrame, values: dict[str, Column]) -> Column:
    """A new open row with the fixed values, as far as the target has the columns."""
    fixed = {c: F.lit(v) for c, v in NEW_CONTACT.items() if c in state.columns}
    return row_after(row_type(state), {**fixed, **values})


def open_and_newest(state: DataFrame, keys: list[str], number: str, begin: str) -> DataFrame:
    """Per key the newest begin date (``newest``) and the open row with the smallest
    number (``before``); one grouped pass, folded map-side."""
    row = F.when(is_open(), F.struct(*state.columns))
    return state.groupBy(*[F.col(k).alias(f"_on_{k}") for k in keys]).agg(
        F.max(begin).alias("newest"),
        F.min_by(row, F.when(is_open(), F.col(number))).alias("before"),
    )


def end_and_insert(
    incoming: DataFrame,
    state: DataFrame,
    value: str,
    into: str,
    as_of: Column,
    rule: str,
    person: str = "id",
    kind: str = "aa",
    number: str = "aa_no",
    begin: str = "beg_date",
) -> DataFrame:
    """New value of a person and kind: end the open row and begin a new one.

    ``rule`` sets the days: ``phone`` ends at the newest begin date and begins the
    day after; ``email`` ends ``as_of`` and begins ``as_of`` or, if later, the day
    after the newest begin date; ``max_plus_one`` ends ``as_of`` and begins the day
    after the newest begin date. A person without any row begins ``as_of``.
    """
    schema = row_type(state)
    found = open_and_newest(state, [person, kind], number, begin)
    batch = incoming.select(
        F.col(person).alias("_person"), F.col(kind).alias("_kind"), F.col(value).alias("_value")
    )
    joined = batch.join(
        found,
        (F.col("_person") == F.col(f"_on_{person}")) & (F.col("_kind") == F.col(f"_on_{kind}")),
        "left",
    )
    newest = F.col("newest")
    after_newest = F.coalesce(next_day(newest), as_of)
    ends = {"phone": newest, "email": as_of, "max_plus_one": as_of}[rule]
    begins = F.greatest(as_of, after_newest) if rule == "email" else after_newest

    ended = change(END, schema, row_after(schema, {"end_date": ends}, "before"), True)
    values = {person: F.col("_person"), kind: F.col("_kind"), begin: begins, into: F.col("_value")}
    added = change(INSERT, schema, new_contact(state, values), False)
    same = change(NONE, schema, F.col("before").cast(schema), True)
    result = (
        F.when(F.col("before").isNull(), F.array(added))
        .when(F.col(f"before.{into}") == F.col("_value"), F.array(same))
        .otherwise(F.array(ended, added))
    )
    return emit(joined, result)


def dated_sequence(
    incoming: DataFrame,
    state: DataFrame,
    value: str,
    into: str,
    day: str,
    as_of: Column,
    rule: str,
    person: str = "id",
    kind: str = "aa",
    number: str = "aa_no",
    begin: str = "beg_date",
    ranges: int | None = None,
) -> DataFrame:
    """Several values of a person and kind in one batch, taken in the order of ``day``.

    The result is what ``end_and_insert`` gives when the rows come one by one, each seeing
    what the ones before have written: a value equal to the one then open changes nothing,
    any other closes the open row and begins a new one. Equal rows count once; values of
    one day come in their own order. Begins follow ``rule`` as there, so those of one batch
    are a day apart; a row that the same batch closes ends no day before it begins. Rule
    ``effective`` begins at the row's own day (``as_of`` if it has none) or, if later, the
    day after the newest begin, and a row ends the day before the next one begins.

    A stored row is ended at most once, and rows that the batch itself closes are inserted
    with their end. A person may have any number of rows (see ``sequence``).
    """
    keys = ["_person", "_kind"]
    schema = row_type(state)
    given = incoming.select(
        F.col(person).alias("_person"), F.col(kind).alias("_kind"), F.col(day).alias("_day"), F.col(value).alias("_value")
    ).distinct()
    found = open_and_newest(state, [person, kind], number, begin).select(
        F.col(f"_on_{person}").alias("_person"), F.col(f"_on_{kind}").alias("_kind"), "newest", "before"
    )
    rows = previous(placed(given, keys, ["_day", "_value"], ranges), keys, "_value", "_prev", "_first")
    rows = spread_join(rows, found, keys, "left")
    open_value = F.when(F.col("_first"), F.col(f"before.{into}")).otherwise(F.col("_prev"))
    rows = written(rows.withColumn("_changed", ~F.coalesce(open_value == F.col("_value"), F.lit(False))), "changed")
    rows = written(running(rows, keys, F.col("_changed").cast("int"), "sum", "_step"), "steps")

    if rule == "effective":
        own = F.unix_date(F.coalesce("_day", as_of)) - F.col("_step")
        steps = running(rows.filter("_changed"), keys, own, "max", "_latest")
        begins = F.date_from_unix_date((F.greatest("_latest", F.unix_date("newest")) + F.col("_step")).cast("int"))
    else:
        steps = rows.filter("_changed")
        first = F.coalesce(next_day(F.col("newest")), as_of)
        first = F.greatest(as_of, first) if rule == "email" else first
        begins = F.date_add(first, (F.col("_step") - 1).cast("int"))
    steps = written(steps.withColumn("_begin", begins), "begins")
    following = steps.select(*keys, (F.col("_step") - 1).alias("_step"), F.col("_begin").alias("_next"))
    steps = spread_join(steps, following, [*keys, "_step"], "left", stored=True)

    day_before = F.date_sub(F.col("_next"), 1)
    closes = {"phone": F.col("newest"), "effective": F.date_sub(F.col("_begin"), 1)}.get(rule, as_of)
    closed = {"phone": F.col("_begin"), "effective": day_before}.get(rule, F.greatest(as_of, F.col("_begin")))
    values = {person: F.col("_person"), kind: F.col("_kind"), begin: F.col("_begin"), into: F.col("_value")}
    end = F.when(F.col("_next").isNotNull(), closed)
    ended = change(END, schema, row_after(schema, {"end_date": closes}, "before"), True)
    added = change(INSERT, schema, new_contact(state, {**values, "end_date": end}), False)
    starts = (F.col("_step") == 1) & F.col("before").isNotNull()
    changes = emit(steps, F.when(starts, F.array(ended, added)).otherwise(F.array(added)))

    held = F.col("_step") == 0
    same = change(NONE, schema, F.col("before").cast(schema), True)
    named = {person: F.col("_person"), kind: F.col("_kind"), into: F.col("_value")}
    again = change(NONE, schema, row_after(schema, named), False)
    return changes.unionByName(emit(rows.filter("not _changed"), F.array(F.when(held, same).otherwise(again))))


def set_phone(incoming: DataFrame, state: DataFrame, as_of: Column, value: str = "phone", **names) -> DataFrame:
    """Mobile phone of a person; the value is kept in ``phone``."""
    return end_and_insert(incoming, state, value, names.pop("into", "phone"), as_of, "phone", **names)


def set_email(
    incoming: DataFrame, state: DataFrame, as_of: Column, value: str = "email", rule: str = "email", **names
) -> DataFrame:
    """Email of a person and kind; the value is kept in ``line1``."""
    return end_and_insert(incoming, state, value, names.pop("into", "line1"), as_of, rule, **names)


def archive_address(old: DataFrame, state: DataFrame, as_of: Column) -> DataFrame:
    """Keep the replaced address ``old`` (person ``id`` and the address columns).

    No open address row: insert one. Open row with the same first line and zip:
    update it. Otherwise end the open row, which becomes a previous address, and
    insert the replaced one from the day after.
    """
    schema = row_type(state)
    open_rows = state.filter(is_open() & of_kinds("aa", ADDRESS_KINDS))
    newest_previous = F.max(F.when(F.col("aa") == PREVIOUS, F.col("beg_date")))
    found = open_rows.groupBy(F.col("id").alias("_on_id")).agg(
        newest_previous.alias("newest"),
        F.min_by(F.struct(*state.columns), F.col("aa_no")).alias("before"),
    )
    batch = old.select(F.col("id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in ADDRESS])
    joined = batch.join(found, F.col("_id") == F.col("_on_id"), "left")
    address = {c: F.col(f"_{c}") for c in ADDRESS}
    last_day = F.greatest(as_of, F.col("newest"))

    def inserted(first_day: Column) -> Column:
        values = {"id": F.col("_id"), "aa": F.lit(PREVIOUS), "beg_date": first_day, **address}
        return change(INSERT, schema, new_contact(state, values), False)

    updated = change(UPDATE, schema, row_after(schema, address, "before"), True)
    closing = {"end_date": last_day, "aa": F.lit(PREVIOUS)}
    ended = change(END, schema, row_after(schema, closing, "before"), True)
    same_place = ~differs(F.col("before.line1"), F.col("_line1")) & ~differs(
        F.col("before.zip"), F.col("_zip")
    )
    result = (
        F.when(F.col("before").isNull(), F.array(inserted(as_of)))
        .when(same_place, F.array(updated))
        .otherwise(F.array(ended, inserted(next_day(last_day))))
    )
    return emit(joined, result)


def set_directory(df: DataFrame, state: DataFrame, as_of: Column) -> DataFrame:
    """Directory row of a person: ``line1`` name, ``line3`` location, phone, extension.

    ``df`` has ``id``, ``fullname``, ``location``, ``phone``, ``ext``. Whether the
    stored row is open is not looked at.
    """
    schema = row_type(state)
    found = (
        state.filter(F.col("aa") == DIRECTORY)
        .groupBy(F.col("id").alias("_on_id"))
        .agg(F.min_by(F.struct(*state.columns), F.col("aa_no")).alias("before"))
    )
    batch = df.select(*[F.col(c).alias(f"_{c}") for c in ("id", "fullname", "location", "phone", "ext")])
    joined = batch.join(found, F.col("_id") == F.col("_on_id"), "left")
    values = {
        "line1": F.col("_fullname"),
        "line3": F.col("_location"),
        "phone": F.col("_phone"),
        "phone_ext": F.col("_ext"),
    }
    first = {
        **values,
        "id": F.col("_id"),
        "aa": F.lit(DIRECTORY),
        "beg_date": as_of,
        "phone_ext": F.lit(""),
    }
    unchanged = F.lit(True)
    for name, value in values.items():
        unchanged = unchanged & ~differs(F.col(f"before.{name}"), value)
    result = (
        F.when(F.col("before").isNull(), change(INSERT, schema, new_contact(state, first), False))
        .when(unchanged, change(NONE, schema, F.col("before").cast(schema), True))
        .otherwise(change(UPDATE, schema, row_after(schema, values, "before"), True))
    )
    return emit(joined, F.array(result))
