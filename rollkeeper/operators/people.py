"""Person, profile and id cross-reference: changes from a batch of cleaned rows.

The batch has one row per person, the feed's short names, and ``id`` as a number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollkeeper.functions import codes, text
from rollkeeper.functions.compare import any_differs
from rollkeeper.functions.dates import age_years
from rollkeeper.operators.changes import (
    INSERT,
    REJECT,
    UPDATE,
    change,
    emit,
    row_after,
    row_type,
    stored_row,
    upsert,
    with_stored,
)
from rollkeeper.operators.chains import doomed
from rollkeeper.operators.lookup import held_by_other, lookup
from rollkeeper.operators.spread import balanced_join
from rollkeeper.session import written

# Feed column per stored address column; the country is compared by
# its code and stored as the validated code.
ADDRESS_FROM = {
    "addr_line1": "primary_address1",
    "addr_line2": "primary_address2",
    "addr_line3": "primary_address3",
    "city": "primary_city",
    "st": "primary_state_code",
    "zip": "primary_zip",
    "ctry": "primary_country_code",
}


def match_people(batch: DataFrame, people: DataFrame, titles: DataFrame, countries: DataFrame) -> DataFrame:
    """The batch with the stored person row (``before``), the validated title and
    country, and whether the address moved. Unknown persons fall out."""
    keyed = batch.withColumn("_title", text.title_key(F.col("salutation")))
    keyed = lookup(keyed, "_title", titles, "title", "title", "_title_code", "")
    keyed = lookup(keyed, "primary_country_code", countries, "ctry", "ctry", "_country", "")
    known = with_stored(keyed, stored_row(people, ["id"]), {"id": "id"})
    moved = any_differs([(F.col(f"before.{old}"), F.col(new)) for old, new in ADDRESS_FROM.items()])
    has_country = ~text.is_blank(F.col("primary_country_code"))
    return known.filter(F.col("before").isNotNull()).withColumn("_moved", has_country & moved)


def person_changes(
    matched: DataFrame, people: DataFrame, parts: tuple[str, ...] = ("basics", "title", "address")
) -> DataFrame:
    """One update per person: names and tax id always, the title where it is a
    known one, the address where it moved."""
    before = F.col("before")
    values: dict[str, Column] = {}
    touched = F.lit(False)
    if "basics" in parts:
        values |= {
            "fullname": F.col("payroll_name"),
            "lastname": F.col("last_name"),
            "firstname": F.col("first_name"),
            "middlename": F.col("middle_name"),
            "ss_no": F.col("ssn"),
            "decsd": F.lit("N"),
            "upd_date": F.col("pos_effective_date"),
            "ofc_add_by": F.lit("HR"),
        }
        touched = F.lit(True)
    if "title" in parts:
        known = F.col("_title_code") != ""
        values["title"] = F.when(known, F.col("_title_code")).otherwise(before.getField("title"))
        touched = touched | known
    if "address" in parts:
        new = {old: F.col(c) for old, c in ADDRESS_FROM.items()}
        new |= {
            "ctry": F.col("_country"),
            "aa": F.lit("PERM"),
            "phone": text.phone(F.col("home_phone")),
        }
        for name, value in new.items():
            values[name] = F.when(F.col("_moved"), value).otherwise(before.getField(name))
        touched = touched | F.col("_moved")
    schema = row_type(people)
    updated = change(UPDATE, schema, row_after(schema, values, "before"), True)
    return emit(matched.filter(touched), F.array(updated))


def replaced_addresses(matched: DataFrame) -> DataFrame:
    """Stored addresses that a new one replaces; one without a first line is not kept."""
    old = matched.filter(F.col("_moved") & F.col("before.addr_line1").isNotNull())
    return old.select(
        "id",
        F.col("before.addr_line1").alias("line1"),
        F.col("before.addr_line2").alias("line2"),
        F.col("before.addr_line3").alias("line3"),
        F.col("before.city").alias("city"),
        F.col("before.st").alias("st"),
        F.col("before.zip").alias("zip"),
        F.col("before.ctry").alias("ctry"),
        text.phone(F.col("home_phone")).alias("phone"),
    )


def profile_changes(batch: DataFrame, profiles: DataFrame, as_of: Column) -> DataFrame:
    values = {
        "sex": F.col("gender"),
        "race": F.col("race"),
        "hispanic": codes.flag_or_no(F.col("ethnicity")),
        "birth_date": F.col("birth_date"),
        "age": age_years(F.col("birth_date"), as_of),
        "prof_last_upd_date": as_of,
    }
    return upsert(batch, profiles, {"id": "id"}, values, {"id": F.col("id"), **values})


def xref_changes(batch: DataFrame, xref: DataFrame) -> DataFrame:
    """Id cross-reference with two guards against an id that someone else holds.

    Unknown person and both ids free: insert. Associate id held by another:
    reject. File number held by another: reject. Otherwise update. An id counts as
    held by whoever has it in the stored table, and by the person of the smallest id
    that asks for it in the batch: of several that ask for a free one, the others
    are rejects.
    """
    seen = with_stored(batch, stored_row(xref, ["cx_id"]), {"id": "cx_id"})
    seen = seen.withColumn("_me", F.coalesce(F.col("before.cx_id"), F.lit(0)))
    seen = held_by_other(
        seen, "employee_assoc_id", "_me", xref, "adp_associate_id", "cx_id", "_assoc_owner"
    )
    seen = held_by_other(seen, "file_number", "_me", xref, "adp_id", "cx_id", "_file_owner")
    seen = written(seen, "xref-seen")
    # Rows that the stored table rejects ask for nothing; then associate ids are dealt out, then file numbers.
    free = seen.filter((F.col("_assoc_owner") == 0) & (F.col("_file_owner") == 0))
    first = free.groupBy("employee_assoc_id").agg(F.min("id").alias("_assoc_first"))
    seen = balanced_join(seen, "employee_assoc_id", first, "employee_assoc_id")
    taken = F.col("_assoc_owner") != 0
    seen = seen.withColumn("_assoc_taken", taken | (F.col("_assoc_first") != F.col("id")))
    left = seen.filter(~F.coalesce("_assoc_taken", F.lit(False)) & (F.col("_file_owner") == 0))
    first = left.groupBy("file_number").agg(F.min("id").alias("_file_first"))
    seen = balanced_join(seen, "file_number", first, "file_number")
    assoc_taken = F.coalesce("_assoc_taken", F.lit(False))
    file_taken = F.coalesce((F.col("_file_owner") != 0) | (F.col("_file_first") != F.col("id")), F.lit(False))
    return _xref_rows(seen, xref, assoc_taken, file_taken)


def _xref_rows(seen: DataFrame, xref: DataFrame, assoc_taken: Column, file_taken: Column) -> DataFrame:
    schema = row_type(xref)
    updates = {
        "old_id": F.col("id"),
        "old_id_num": F.col("id"),
        "adp_id": F.col("file_number"),
        "ssn": F.col("ssn"),
        "adp_associate_id": F.col("employee_assoc_id"),
    }
    inserts = {**updates, "cx_id": F.col("id"), "cx_id_char": F.col("id")}
    candidate = row_after(schema, inserts)
    reason = F.when(assoc_taken, "associate_id_held").otherwise("file_number_held")
    result = (
        F.when(assoc_taken | file_taken, change(REJECT, schema, candidate, False, reason))
        .when(F.col("before").isNull(), change(INSERT, schema, candidate, False))
        .otherwise(change(UPDATE, schema, row_after(schema, updates, "before"), True))
    )
    return emit(seen, F.array(result))


# The two ids of the cross-reference: batch column, stored column.
XREF_IDS = {"a": ("employee_assoc_id", "adp_associate_id"), "f": ("file_number", "adp_id")}


def _kept(xref: DataFrame, batch: DataFrame, asked: str, stored: str) -> DataFrame:
    """Stored ids that their owner doesn't give up: no row in the batch, or one that asks for the same id."""
    given = batch.select(F.col("id").alias("_id"), F.col(asked).alias("_asked"), F.lit(True).alias("_in"))
    rows = xref.select("cx_id", stored).join(given, F.col("cx_id") == F.col("_id"), "left")
    return rows.filter(F.col("_in").isNull() | (F.col("_asked") == F.col(stored))).select("cx_id", stored)


def xref_in_order(batch: DataFrame, xref: DataFrame) -> DataFrame:
    """Id cross-reference where an id that one person gives up in a batch may go to another.

    Taken in a good order, rows that free an id come before those that want it. A person
    is refused an id that another one keeps: who has it and isn't in the batch, asks for it
    again, or is refused itself, and so keeps what it has. That goes back along chains of
    any length (``chains``); persons in a ring, who want each other's ids, wait for one
    another and are refused, whatever the order. Of several who could get an id the smallest
    person id does, associate ids first, then file numbers; who waits for one of the others
    is refused too. An id that is left over this way is free from the next batch on.
    """
    batch = written(batch, "xref-batch")
    seen = with_stored(batch, stored_row(xref, ["cx_id"]), {"id": "cx_id"})
    for kind, (asked, stored) in XREF_IDS.items():
        kept = written(_kept(xref, batch, asked, stored), "kept-ids")
        seen = held_by_other(seen, asked, "id", kept, stored, "cx_id", f"_{kind}_owner")
    seen = written(seen, "xref-seen")

    # a person waits for the ids it asks for, and an id for the persons who are to give it up
    def node(kind: str, c: str) -> Column:
        return F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))

    person = node("p", "id")
    steps = []
    for kind, (asked, stored) in XREF_IDS.items():
        wants = seen.filter(F.col(asked).isNotNull() & ~F.coalesce(F.col(f"before.{stored}") == F.col(asked), F.lit(False)))
        steps.append(wants.select(person.alias("a"), node(kind, asked).alias("b")))
        gives = batch.select("id", F.col(asked).alias("_asked")).join(xref.select("cx_id", stored), F.col("id") == F.col("cx_id"))
        gives = gives.filter(F.col(stored).isNotNull() & ~F.coalesce(F.col("_asked") == F.col(stored), F.lit(False)))
        steps.append(gives.select(node(kind, stored).alias("a"), person.alias("b")))
    steps = written(reduce(DataFrame.unionByName, steps), "xref-steps")

    refused = seen.filter((F.col("_a_owner") != 0) | (F.col("_f_owner") != 0)).select(person.alias("n"))
    lost = doomed(steps, refused)
    able = seen.join(lost, person == F.col("n"), "left_anti")
    dealt = []
    for kind, (asked, _) in XREF_IDS.items():
        first = able.groupBy(asked).agg(F.min("id").alias("_first"))
        able = written(balanced_join(able, asked, first, asked), "dealt")
        beaten = F.coalesce(F.col("_first") != F.col("id"), F.lit(False))
        dealt.append(able.filter(beaten).select("id", F.lit(kind).alias("_beaten")))
        able = able.filter(~beaten).drop("_first")
    beaten = written(dealt[0].unionByName(dealt[1]), "beaten")
    lost = doomed(steps, lost.unionByName(beaten.select(person.alias("n"))))

    # what a refused person is refused for: the associate id if that can't be had, else the file number
    seen = seen.join(beaten.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").drop("_id")
    for kind, (asked, _) in XREF_IDS.items():
        unfree = lost.filter(F.col("n").startswith(f"{kind}:")).withColumnRenamed("n", f"_{kind}_lost")
        seen = seen.join(unfree, node(kind, asked) == F.col(f"_{kind}_lost"), "left")
    refused = lost.filter(F.col("n").startswith("p:")).withColumnRenamed("n", "_refused")
    seen = seen.join(refused, person == F.col("_refused"), "left")
    wants = ~F.coalesce(F.col("before.adp_associate_id") == F.col("employee_assoc_id"), F.lit(False))
    waits = wants & F.col("_a_lost").isNotNull()
    assoc = (F.col("_a_owner") != 0) | F.coalesce(F.col("_beaten") == "a", F.lit(False)) | waits
    return _xref_rows(seen, xref, F.col("_refused").isNotNull() & assoc, F.col("_refused").isNotNull())
